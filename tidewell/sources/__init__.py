"""Readers and writers: landing payloads, layered lake, serving table."""
