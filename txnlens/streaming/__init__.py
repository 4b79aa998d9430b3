"""Structured Streaming: replay, online features, scoring, sinks."""
