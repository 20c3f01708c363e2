"""Structured Streaming extensions of our own; the batch operators are the reference semantics."""
