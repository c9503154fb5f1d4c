"""Structured Streaming: ingest, hourly means, latest readings, live warnings."""
