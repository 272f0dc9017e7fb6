"""Task parameters: the query API of the job."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from visitloom.schemas import TASK_PARAM_FIELDS


def _choices(text: str | None) -> tuple[str, ...] | None:
    """``"a,b"`` -> ``("a", "b")``; missing or empty text turns the predicate off."""
    if not text:
        return None
    return tuple(part for part in text.split(",") if part)


@dataclass(frozen=True)
class TaskParams:
    """Filters of one task. ``None`` means "no restriction".

    An age range counts only when both ends are given; an open date end is
    unbounded. An empty tuple matches nothing.
    """

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: tuple[str, ...] | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[str, ...] | None = None

    @classmethod
    def from_values(cls, values: Mapping[str, str | None]) -> TaskParams:
        """Build from one text per parameter (several choices joined by commas)."""
        unknown = set(values) - set(TASK_PARAM_FIELDS)
        if unknown:
            raise ValueError(f"unknown task parameters: {sorted(unknown)}")
        start_age, end_age = values.get("startAge"), values.get("endAge")
        return cls(
            start_date=values.get("startDate") or None,
            end_date=values.get("endDate") or None,
            start_age=int(start_age) if start_age else None,
            end_age=int(end_age) if end_age else None,
            professionals=_choices(values.get("professionals")),
            cities=_choices(values.get("cities")),
            sex=_choices(values.get("sex")),
            keywords=_choices(values.get("keywords")),
            category_ids=_choices(values.get("categoryIds")),
        )

    @classmethod
    def from_json(cls, document: str | None) -> TaskParams:
        """Build from a task's JSON document, whose fields are arrays; element 0 counts."""
        if not document:
            raise ValueError("task has no parameter document")
        fields: Any = json.loads(document)
        if not isinstance(fields, dict):
            raise ValueError("task parameters must be a JSON object")
        values: dict[str, str | None] = {}
        for name in TASK_PARAM_FIELDS:
            items = fields.get(name)
            if isinstance(items, list) and items and items[0] is not None:
                values[name] = str(items[0])
        return cls.from_values(values)
