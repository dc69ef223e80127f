"""Structured Streaming: job runners, stateful detectors, progress metrics."""
