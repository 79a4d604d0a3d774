"""Task parameters of the session analysis.

Keys follow the task JSON of the original application (``startDate``,
``endDate``, ``startAge``, ``endAge``, ``professionals``, ``cities``, ``sex``,
``keywords``, ``categoryIds``, ``targetPageFlow``). A missing key and an empty
string both mean "no constraint".
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field


def _csv(value) -> tuple[str, ...]:
    if value is None:
        return ()
    if isinstance(value, (list, tuple)):
        items = [str(v).strip() for v in value]
    else:
        items = [v.strip() for v in str(value).split(",")]
    return tuple(v for v in items if v)


def _opt_int(value) -> int | None:
    if value is None or str(value).strip() == "":
        return None
    return int(value)


def _date(value: str) -> str:
    """An ISO date; anything else raises before it can reach a statement."""
    return dt.date.fromisoformat(value).isoformat()


def _opt_str(value) -> str | None:
    if value is None or str(value).strip() == "":
        return None
    return str(value).strip()


@dataclass(frozen=True)
class TaskParams:
    start_date: str
    end_date: str
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()
    target_page_flow: tuple[int, ...] = field(default=())
    # The original applies the age range only when both ends are given.
    # With strict_bounds=False a single given end is honoured as well.
    strict_bounds: bool = True

    @classmethod
    def from_dict(cls, raw: dict) -> "TaskParams":
        start, end = _opt_str(raw.get("startDate")), _opt_str(raw.get("endDate"))
        if start is None or end is None:
            raise ValueError("startDate and endDate are required")
        return cls(
            start_date=_date(start),
            end_date=_date(end),
            start_age=_opt_int(raw.get("startAge")),
            end_age=_opt_int(raw.get("endAge")),
            professionals=_csv(raw.get("professionals")),
            cities=_csv(raw.get("cities")),
            sex=_opt_str(raw.get("sex")),
            keywords=_csv(raw.get("keywords")),
            category_ids=tuple(int(v) for v in _csv(raw.get("categoryIds"))),
            target_page_flow=tuple(int(v) for v in _csv(raw.get("targetPageFlow"))),
        )

    @classmethod
    def from_json(cls, text: str) -> "TaskParams":
        return cls.from_dict(json.loads(text))
