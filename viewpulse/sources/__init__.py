"""Readers: log files and tables, streams, terminal lookup."""
