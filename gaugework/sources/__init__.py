"""Readers and writers: files, nested records, signal store, reference tables, logs."""
