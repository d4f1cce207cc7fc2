"""Readers: click streams, table scans, offsets and lookups."""
