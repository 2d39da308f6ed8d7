"""A range of days, one after the other, that stops at the first failure and can be resumed."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, timedelta

from ..plans.store import iso_day


def day_of(text: str) -> date:
    return date.fromisoformat(iso_day(text))


def bounds(day: date | None = None, start: date | None = None, end: date | None = None, resume: date | None = None) -> tuple[date, date]:
    """First and last day of a run: either one day or a range, begun at `resume` if given."""
    if (day is None) == (start is None and end is None) or (day is None and (start is None or end is None)):
        raise ValueError("give either one day or both ends of a range")
    first, last = (day, day) if day is not None else (start, end)
    if first > last:
        raise ValueError("the range ends before it begins")
    if resume is not None and not first <= resume <= last:
        raise ValueError("the day to resume at is outside the range")
    return resume or first, last


def days(first: date, last: date) -> Iterator[date]:
    """Every day, both ends included; never steps beyond the last."""
    if first > last:
        raise ValueError("the range ends before it begins")
    for n in range((last - first).days + 1):
        yield first + timedelta(days=n)


def run_days(run: Callable[[str, date, str], object], stage: str, first: date, last: date, from_stage: str = "ingest") -> list[date]:
    """Run a stage on each day; `from_stage` holds for the first day only. The first failure ends the run."""
    done = []
    for day in days(first, last):
        start_at = from_stage if day == first else "ingest"
        try:
            run(stage, day, start_at)
        except Exception:
            hint = " and --from-stage <stage>" if stage == "pipeline" else ""
            print(f"{day} failed in {stage}; later days were not started. Resume with --resume-date {day}{hint}.", flush=True)
            raise
        done.append(day)
    return done
