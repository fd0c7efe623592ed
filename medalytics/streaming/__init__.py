"""Structured Streaming form of the near-real-time steps."""
