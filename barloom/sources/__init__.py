"""Readers and writers: price CSV, fetched bodies, landed tables, scratch."""
