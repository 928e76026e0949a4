"""Readers and writers for topics, tables and files."""
