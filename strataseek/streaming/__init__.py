"""Structured Streaming forms of event monitoring, dedupe and index upkeep."""
