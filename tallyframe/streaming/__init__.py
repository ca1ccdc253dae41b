"""Scheduled runs over a folder that keeps receiving files."""

from .arrivals import process_new_files

__all__ = ["process_new_files"]
