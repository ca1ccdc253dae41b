"""Registered queries: every operator over whole driver tables, with its SQL counterpart."""

from . import aggregation, columns, joining, jobs, limits, reshaping, scalars, sinks, windowing
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "aggregation", "columns", "jobs", "joining", "limits", "reshaping", "scalars", "sinks", "windowing"]
