"""Continuous scoring and alerting with Structured Streaming."""
