"""Structured Streaming operators, each with a batch twin."""
