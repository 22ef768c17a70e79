"""Readers and writers of recorded streams, tables and reports."""
