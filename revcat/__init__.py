"""Revisable event catalogs on Spark."""

from revcat.schema import EVENTS, RUNS, conform
from revcat.session import clean_scratch, pin_utc, scratch_dir, session

__all__ = ["EVENTS", "RUNS", "clean_scratch", "conform", "pin_utc", "scratch_dir", "session"]
