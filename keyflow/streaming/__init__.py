"""Structured Streaming forms: stateful processors, twins of batch queries, resumable runs."""
