"""All registered queries and their SQL oracles."""

from __future__ import annotations

from . import analysis, barcodes, counting, more, receptors, rows, stages, storage  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
