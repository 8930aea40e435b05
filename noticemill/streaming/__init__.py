"""Structured Streaming variants of list intake and of reporting new notices."""
