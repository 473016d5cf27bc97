"""Structured Streaming forms of scoring, audit and drift."""
