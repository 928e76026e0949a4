"""Continuous forms of the operators, and their sinks."""
