"""Structured Streaming jobs over camera frames."""
