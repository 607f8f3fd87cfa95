"""Readers and writers: flow files, requests, service tables, exports."""
