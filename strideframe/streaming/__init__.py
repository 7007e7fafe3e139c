"""Structured Streaming forms of scoring, windowing and live A/B accuracy."""
