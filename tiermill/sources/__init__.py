"""Readers: files, JDBC tables, message topics."""
