"""Imports composed of the sources, functions, operators and sinks."""
