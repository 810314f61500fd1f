"""Structured Streaming: detection and monitoring."""
