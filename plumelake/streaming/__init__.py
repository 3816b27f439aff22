"""Structured Streaming forms of the operators. Every query can run with
``availableNow`` from any outside scheduler, or with a processing-time trigger."""
