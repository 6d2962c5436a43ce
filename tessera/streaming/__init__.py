"""Structured Streaming operators with per-micro-batch semantics."""
