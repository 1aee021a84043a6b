"""Structured Streaming: watermarked daily features, live scoring, alerts."""
