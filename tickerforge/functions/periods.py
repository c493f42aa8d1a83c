"""Date ranges and filters as users write them; evaluated on the driver."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Days that one observation of each frequency stands for.
DAYS = {"day": 1, "week": 7, "month": 30, "quarter": 90, "semi-annual": 180, "annual": 365}


def parse_day(value: date | str | None) -> date | None:
    return date.fromisoformat(value) if isinstance(value, str) else value


def date_range(start: date | str | None = None, end: date | str | None = None, limit: int | None = None, frequency: str = "day", today: date | None = None) -> tuple[date | None, date | None]:
    """The dates to fetch for a request; ``limit`` counts observations of the frequency.

    A start alone runs to today; a limit counts from the start (not beyond today), or back from the
    end; a limit alone looks back twice its span from today. All three together are an error.
    """
    if frequency not in DAYS:
        raise ValueError(f"frequency must be one of {', '.join(DAYS)}, not {frequency!r}")
    first, last, today = parse_day(start), parse_day(end), today or date.today()
    if limit is None:
        return (first, today) if first and not last else (first, last)
    if first and last:
        raise ValueError("start, end and limit can't be given together")
    span = timedelta(days=limit * DAYS[frequency])
    if first:
        return first, min(first + span, today)
    if last:
        return last - span, last
    return today - 2 * span, today


def parse_bounds(filters: tuple[str, ...] | list[str], whole: bool = False) -> tuple[float | int | None, float | int | None]:
    """(more than, less than) from filters such as ``>50`` and ``<100``, each given once at most."""
    found: dict[str, float | int] = {}
    for text in filter(None, (f.strip() if f else f for f in filters)):
        sign = text[0]
        if sign not in "<>":
            raise ValueError(f"a filter starts with > or <: {text}")
        if sign in found:
            raise ValueError(f"more than one {sign!r} filter")
        try:
            number = float(text[1:])
        except ValueError:
            raise ValueError(f"not a number: {text[1:]}") from None
        found[sign] = int(number) if whole else number
    return found.get(">"), found.get("<")


def bounds(column: str, more: float | None, less: float | None) -> list[Column]:
    """Strict predicates; a null value meets neither."""
    return [F.col(column) > more] * (more is not None) + [F.col(column) < less] * (less is not None)
