"""Structured Streaming: documents as they arrive, and live job state."""
