"""Streaming ingest: the batch core inside foreachBatch, plus raw append."""
