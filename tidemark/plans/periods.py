"""The spans one run covers, as plain values."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

TEN_MINUTES = timedelta(minutes=10)
HOUR = timedelta(hours=1)
DAY = timedelta(days=1)
WEEK = timedelta(days=7)


@dataclass(frozen=True)
class Period:
    """Half-open span of wall-clock time."""

    start: datetime
    end: datetime

    def __post_init__(self):
        if self.end <= self.start:
            raise ValueError(f"empty period: {self.start} to {self.end}")

    def days(self) -> tuple[date, date]:
        """First and last calendar day touched."""
        return self.start.date(), (self.end - timedelta(microseconds=1)).date()

    def in_zone(self, source: str, target: str) -> Period:
        """The same span in the wall-clock time of another zone."""
        if source == target:
            return self

        def move(moment: datetime) -> datetime:
            aware = moment.replace(tzinfo=ZoneInfo(source))
            return aware.astimezone(ZoneInfo(target)).replace(tzinfo=None)

        return Period(move(self.start), move(self.end))


# The unit the periods of a table's grain are made of.
UNITS = {"minutes": TEN_MINUTES, "hourly": HOUR, "daily": DAY, "weekly": DAY}


def require_whole(period: Period, grain: str) -> None:
    """A period that is not whole units of its grain would replace parts of rows."""
    for moment in (period.start, period.end):
        midnight = datetime.combine(moment.date(), time())
        if (moment - midnight) % UNITS[grain]:
            raise ValueError(f"{moment} is not on a boundary of {grain} tables")
    if grain == "weekly" and (period.end - period.start) % WEEK:
        raise ValueError(f"{period.start} to {period.end} is not whole weeks")


def _parse(text: str, form: str) -> datetime:
    try:
        return datetime.strptime(text, form)
    except ValueError as e:
        raise ValueError(f"{text!r} is not of the form {form}") from e


def _floor_ten(now: datetime) -> datetime:
    return now.replace(minute=now.minute - now.minute % 10, second=0, microsecond=0)


def ten_minutes(text: str | None = None, now: datetime | None = None) -> Period:
    """``2024-01-15T14:30``, or the last closed ten minutes before ``now``."""
    if text is None:
        end = _floor_ten(_now(now))
        return Period(end - TEN_MINUTES, end)
    start = _parse(text, "%Y-%m-%dT%H:%M")
    if start != _floor_ten(start):
        raise ValueError(f"{text!r} does not start on a ten-minute boundary")
    return Period(start, start + TEN_MINUTES)


def hour(text: str | None = None, now: datetime | None = None) -> Period:
    """``2024-01-15T14``, or the last closed hour before ``now``."""
    if text is None:
        end = _now(now).replace(minute=0, second=0, microsecond=0)
        return Period(end - HOUR, end)
    start = _parse(text, "%Y-%m-%dT%H")
    return Period(start, start + HOUR)


def day(text: str | None = None, now: datetime | None = None) -> Period:
    """``2024-01-15``, or the day before ``now``."""
    end = None if text else datetime.combine(_now(now).date(), time())
    start = _parse(text, "%Y-%m-%d") if text else end - DAY
    return Period(start, start + DAY)


def week(text: str | None = None, now: datetime | None = None) -> Period:
    """Seven days from ``2024-01-15``, or the seven that end the day before ``now``."""
    if text is None:
        end = datetime.combine(_now(now).date(), time())
        return Period(end - WEEK, end)
    start = _parse(text, "%Y-%m-%d")
    return Period(start, start + WEEK)


def run_period(grain: str, text: str | None = None, now: datetime | None = None) -> Period:
    """The period of one run. Minute and hourly runs may also be given a wider
    span: an hour or a day for minutes, a day for hourly."""
    forms = {
        "minutes": [ten_minutes, hour, day],
        "hourly": [hour, day],
        "daily": [day],
        "weekly": [week],
    }
    if text is None:
        return forms[grain][0](None, now)
    by_length = {16: ten_minutes, 13: hour, 10: week if grain == "weekly" else day}
    parse = by_length.get(len(text))
    if parse not in forms[grain]:
        raise ValueError(f"{text!r} is not a period of a {grain} run")
    return parse(text)


def backfill_days(
    start: str | None = None, end: str | None = None, now: datetime | None = None
) -> Period:
    """Whole days from ``start`` to ``end`` inclusive.

    Nothing given means yesterday, one date means that day. A start after today
    is an error; an end after today is cut to today.
    """
    today = datetime.combine(_now(now).date(), time())
    first = _parse(start, "%Y-%m-%d") if start else today - DAY
    last = _parse(end, "%Y-%m-%d") if end else first
    if first > today:
        raise ValueError(f"backfill starts after today: {start}")
    return Period(first, min(last, today) + DAY)


def complete_weeks(days: Period) -> Period | None:
    """The whole weeks from the first day on; a shorter tail is left out."""
    weeks = (days.end - days.start) // WEEK
    return Period(days.start, days.start + weeks * WEEK) if weeks else None


def runs_of_days(days: list[str]) -> list[Period]:
    """Days in order, those that follow each other as one period."""
    runs: list[Period] = []
    for day in map(datetime.fromisoformat, days):
        if runs and runs[-1].end == day:
            runs[-1] = Period(runs[-1].start, day + DAY)
        else:
            runs.append(Period(day, day + DAY))
    return runs


def _now(now: datetime | None) -> datetime:
    return datetime.now() if now is None else now
