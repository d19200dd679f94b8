"""Structured Streaming form of the gated append."""
