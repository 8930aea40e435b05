"""Readers and writers: list files, HTML pages, the registry, output lines."""
