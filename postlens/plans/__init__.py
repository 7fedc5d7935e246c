"""Composite jobs built from sources, operators and sinks."""
