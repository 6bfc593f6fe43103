"""Structured Streaming jobs: lake layout, sinks, and the layer runners."""
