"""Streaming: fitted preparation and scoring applied to a stream of files."""
