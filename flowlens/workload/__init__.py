"""Registered queries over the driver tables, each next to its equivalent SQL.

Every module has ``QUERIES`` (name → function of session and table folder) and ``ORACLES``
(name → SQL). Queries that SQL cannot state have no oracle and are tested elsewhere.
"""
