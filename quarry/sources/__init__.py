"""Readers and writers: corpus tables, judgments, JSON records, persisted index tables."""
