"""Mixing as a stream."""
