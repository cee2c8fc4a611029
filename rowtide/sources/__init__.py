"""Readers and writers of tables, logs, topics and catalogs."""
