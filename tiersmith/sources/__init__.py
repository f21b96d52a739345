"""Readers and writers: landing files, archives, tables, pages and brands."""
