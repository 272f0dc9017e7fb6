"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio2(part: str, whole: str) -> Column:
    """``part / whole`` rounded half up to 2 decimals; null when ``whole`` is 0.

    Works on whole numbers, so that no binary fraction decides a tie.
    """
    return F.expr(f"((200 * {part} + {whole}) div nullif(2 * {whole}, 0)) / 100D")
