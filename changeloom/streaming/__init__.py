"""Continuous pick-up of change files with Structured Streaming."""

from .follow import apply_landed, follow, land_files

__all__ = ["apply_landed", "follow", "land_files"]
