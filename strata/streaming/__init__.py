"""Structured Streaming: file-once ingest and micro-batch upserts."""

from strata.streaming.file_once import ingest_new_files, stream_upsert

__all__ = ["ingest_new_files", "stream_upsert"]
