"""Structured Streaming form of the per-minute API traffic."""
