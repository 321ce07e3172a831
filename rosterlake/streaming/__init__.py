"""Structured Streaming jobs: windowed counts, change logs and upserts into the serving table."""
