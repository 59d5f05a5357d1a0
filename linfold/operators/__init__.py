"""Distributed operators over point frames."""
