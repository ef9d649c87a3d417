"""Readers: url lists, pages, job logs, access lists."""
