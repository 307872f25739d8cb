"""Dates in several spellings, ages and time slots."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.UTC)


@dataclass(frozen=True)
class Clock:
    """The moment a job counts as now, read once and the same in all its columns.

    ``current_timestamp`` is another moment in every query of a job, and when it is
    run again. A rerun that is given the moment of the first run repeats its result.
    """

    moment: datetime.datetime = field(default_factory=_now)

    @staticmethod
    def at(text: str) -> Clock:
        """The clock of an earlier run, from :meth:`text`; a moment without a zone is in UTC."""
        moment = datetime.datetime.fromisoformat(text)
        return Clock(moment if moment.tzinfo else moment.replace(tzinfo=datetime.UTC))

    def text(self) -> str:
        return self.moment.astimezone(datetime.UTC).isoformat()

    def timestamp(self) -> Column:
        return F.lit(self.text()).cast("timestamp")

    def date(self) -> Column:
        """The day in the session's time zone."""
        return self.timestamp().cast("date")

    def stamped(self, df: DataFrame) -> DataFrame:
        """``df`` with ``current_date`` and ``current_timestamp`` of this clock."""
        return df.withColumns({"current_date": self.date(), "current_timestamp": self.timestamp()})


def parse_date(text: Column, formats: Sequence[str]) -> Column:
    """The date by the first format that fits, null if none does.

    One pass over the data: no parse per format followed by a union.
    """
    return F.coalesce(*[F.try_to_date(text, pattern) for pattern in formats])


def not_after(date: Column, as_of: Column) -> Column:
    """A date read from a two-digit year, moved back 100 years if it lies after ``as_of``."""
    return F.when(date > as_of, F.add_months(date, -1200)).otherwise(date)


def age_in_years(date: Column, as_of: Column | None = None) -> Column:
    """Days between the two dates over 365, as a double; ``as_of`` defaults to today."""
    return F.datediff(F.current_date() if as_of is None else as_of, date) / 365


def nearest_slot(moment: Column, seconds: int = 300) -> Column:
    """Number of the time slot nearest to a moment, counted from 1970.

    Halves go away from zero, as ``round`` has it; on whole seconds a floor
    gives the same and costs far less than rounding doubles.
    """
    second = F.unix_timestamp(moment)
    earlier = F.when(second < 0, 1 - seconds % 2).otherwise(0)
    return F.floor((second + seconds // 2 - earlier) / seconds).cast("int")


def slot_time(slot: Column, seconds: int = 300) -> Column:
    """The moment a slot number stands for, as text."""
    return F.from_unixtime(slot.cast("long") * seconds)
