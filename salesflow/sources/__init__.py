"""Readers and writers: raw files, the lake, published views, the test tables."""
