"""Readers and writers: wire records, JSON lines, CSV, binary files and snapshots."""
