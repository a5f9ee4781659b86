"""Structured Streaming: scoring, model hot swap, windowed drift."""
