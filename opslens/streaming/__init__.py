"""Structured Streaming processors for the machine and customer streams."""
