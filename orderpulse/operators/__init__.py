"""Batch operators; those built on plain aggregates also run on streams."""
