"""Whole queries put together from sources, operators and sinks."""
