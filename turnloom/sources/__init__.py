"""Readers and writers for the files a corpus is built from."""
