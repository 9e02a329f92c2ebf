"""Queries on the shared test tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from . import codes_and_text, counts, features, histories, pipelines, rows, values  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
