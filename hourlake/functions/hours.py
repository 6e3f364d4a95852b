"""Hour ranges, landing-path globs and hour partition columns."""

from __future__ import annotations

import calendar
from collections import defaultdict
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from typing import Iterator, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTITION_COLUMNS = ("year", "month", "day", "hour")

# Landing layouts. "plain" is <root>/YYYY/MM/DD/HH/<file>; "hive" names every
# level, <root>/year=YYYY/month=MM/day=DD/hour=HH/<file>, which is what Spark's
# own partitioned writers produce.
LAYOUTS = ("plain", "hive")

_WIDTHS = (4, 2, 2, 2)
_ANY = ("[0-9][0-9][0-9][0-9]", "[0-9][0-9]", "[0-9][0-9]", "[0-9][0-9]")

HourSpec = Union[None, str, datetime, tuple, "HourRange"]


def _hour(value) -> datetime:
    if isinstance(value, datetime):
        dt = value
    else:
        text = str(value).strip().replace("T", " ")
        for fmt in ("%Y-%m-%d %H", "%Y-%m-%d %H:%M", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d"):
            try:
                dt = datetime.strptime(text, fmt)
                break
            except ValueError:
                continue
        else:
            raise ValueError(f"not an hour: {value!r} (expected 'YYYY-MM-DD HH')")
    if dt.tzinfo is not None:
        dt = dt.astimezone(timezone.utc).replace(tzinfo=None)
    return dt.replace(minute=0, second=0, microsecond=0)


def _is_day(spec) -> bool:
    """Whether ``spec`` is 'YYYY-MM-DD', a whole day."""
    return isinstance(spec, str) and len(spec.strip()) == 10


@dataclass(frozen=True)
class HourRange:
    """An inclusive range of UTC hours; ``everything`` selects every landed hour.

    ``parse`` takes None (the current hour), 'YYYY-MM-DD HH' (one hour),
    'YYYY-MM-DD' (the whole day), a (start, end) pair, or 'all'. A day that
    ends a pair is in it up to its last hour. ``of`` takes any set of hours.
    """

    start: datetime | None = None
    end: datetime | None = None
    everything: bool = False
    #: Hours of a range with gaps, ascending; None if it has none.
    only: tuple[datetime, ...] | None = None

    @classmethod
    def parse(cls, spec: HourSpec) -> "HourRange":
        if isinstance(spec, HourRange):
            return spec
        if spec is None:
            now = datetime.now(timezone.utc)
            return cls(_hour(now), _hour(now))
        if isinstance(spec, str) and spec.strip().lower() in ("all", "*"):
            return cls(everything=True)
        if isinstance(spec, (tuple, list)):
            start, end = _hour(spec[0]), _hour(spec[1])
            if _is_day(spec[1]):
                end += timedelta(hours=23)
            if end < start:
                raise ValueError(f"hour range ends before it starts: {spec!r}")
            return cls(start, end)
        if _is_day(spec):
            day = _hour(spec)
            return cls(day, day + timedelta(hours=23))
        hour = _hour(spec)
        return cls(hour, hour)

    @classmethod
    def of(cls, hours) -> "HourRange":
        """Exactly these hours, at least one."""
        some = tuple(sorted({_hour(h) for h in hours}))
        return cls(some[0], some[-1], only=some)

    def hours(self) -> Iterator[datetime]:
        if self.everything:
            raise ValueError("an open hour range has no hour list")
        if self.only is not None:
            yield from self.only
            return
        cur = self.start
        while cur <= self.end:
            yield cur
            cur += timedelta(hours=1)

    def __len__(self) -> int:
        if self.only is not None:
            return len(self.only)
        return int((self.end - self.start).total_seconds() // 3600) + 1

    def keys(self) -> tuple[str, str]:
        """First and last hour as sortable 'YYYYMMDDHH' strings."""
        return self.start.strftime("%Y%m%d%H"), self.end.strftime("%Y%m%d%H")


def _level(layout: str, i: int, value: str) -> str:
    if layout == "hive":
        return f"{PARTITION_COLUMNS[i]}={value}"
    if layout == "plain":
        return value
    raise ValueError(f"unknown layout {layout!r}; use one of {LAYOUTS}")


def _fmt(layout: str, i: int, number: int) -> str:
    return _level(layout, i, str(number).zfill(_WIDTHS[i]))


def level_wildcard(layout: str, i: int) -> str:
    return _level(layout, i, _ANY[i])


def _alternatives(parts: list[str]) -> str:
    return parts[0] if len(parts) == 1 else "{" + ",".join(parts) + "}"


def hour_glob(root: str, hours: HourSpec, layout: str = "plain") -> str:
    """One Hadoop glob that matches exactly the hour directories of ``hours``.

    Whole months and whole days collapse to digit wildcards, so the pattern
    stays short for long ranges; a single glob lets Spark list every matched
    directory in one (parallel) listing job.
    """
    root = root.rstrip("/")
    hr = HourRange.parse(hours)
    if hr.everything:
        return root + "/" + "/".join(level_wildcard(layout, i) for i in range(4))
    months: dict[tuple[int, int], dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
    for h in hr.hours():
        months[(h.year, h.month)][h.day].append(h.hour)
    parts = []
    for (year, month), days in sorted(months.items()):
        prefix = f"{_fmt(layout, 0, year)}/{_fmt(layout, 1, month)}"
        full_days = [d for d, hs in days.items() if len(hs) == 24]
        if len(full_days) == calendar.monthrange(year, month)[1]:
            parts.append(f"{prefix}/{level_wildcard(layout, 2)}/{level_wildcard(layout, 3)}")
            continue
        for day, hs in sorted(days.items()):
            if len(hs) == 24:
                leaf = level_wildcard(layout, 3)
            else:
                leaf = _level(layout, 3, _alternatives([f"{h:02d}" for h in sorted(hs)]))
            parts.append(f"{prefix}/{_fmt(layout, 2, day)}/{leaf}")
    return root + "/" + _alternatives(parts)


# The folders of an hour below the root, a # for every digit, and where the digits of
# each level begin in them.
_SHAPES = {"plain": "####/##/##/##/", "hive": "year=####/month=##/day=##/hour=##/"}
_STARTS = {"plain": (1, 6, 9, 12), "hive": (6, 17, 24, 32)}


def below_root(path: Column, root_path: str) -> Column:
    """The part of a file's path behind its root's, whatever scheme and host stand before that. A path that is
    not below the root is an error: its file must not drop out unseen."""
    at = F.locate(root_path + "/", path)
    found = F.substring(path, at + len(root_path) + 1, F.length(path))
    return F.when(at > 0, found).otherwise(F.raise_error(F.concat(path, F.lit(f" is not below {root_path}"))))


def in_hour_folder(relative: Column, layout: str = "plain") -> Column:
    """Whether a path below the root begins with the folders of an hour.

    The optimizer hands a condition on one side of a join to the other, whose paths may lie below another root; it
    leaves one that depends on where a row is, as the (always true) outer one does, where it stands."""
    shape = _SHAPES[layout]
    begins = F.translate(F.substring(relative, 1, len(shape)), "#0123456789", "-##########") == F.lit(shape)
    return F.when(F.spark_partition_id() >= 0, begins)


def hour_columns_from_path(relative: Column, layout: str = "plain") -> list[Column]:
    """year/month/day/hour strings, by their places, of a path below the root that is :func:`in_hour_folder`."""
    return [F.substring(relative, start, width).alias(name)
            for start, width, name in zip(_STARTS[layout], _WIDTHS, PARTITION_COLUMNS)]


def are_hour_keys() -> Column:
    """Whether the hour key columns hold an hour's digits; on partition columns it selects folders, not rows."""
    return F.concat_ws("/", *[F.col(c) for c in PARTITION_COLUMNS]).rlike("^[0-9]{4}/[0-9]{2}/[0-9]{2}/[0-9]{2}$")


def hour_columns_from_ts(ts: Column) -> list[Column]:
    """Zero-padded year/month/day/hour strings of a timestamp column."""
    fmts = ("yyyy", "MM", "dd", "HH")
    return [F.date_format(ts, f).alias(n) for f, n in zip(fmts, PARTITION_COLUMNS)]


def hour_predicate(hours: HourSpec) -> Column | None:
    """Predicate on the string hour columns; it only touches partition
    columns, so Spark turns it into a PartitionFilter."""
    hr = HourRange.parse(hours)
    if hr.everything:
        return None
    if hr.start == hr.end:
        h = hr.start
        values = (f"{h.year:04d}", f"{h.month:02d}", f"{h.day:02d}", f"{h.hour:02d}")
        cond = None
        for name, value in zip(PARTITION_COLUMNS, values):
            term = F.col(name) == F.lit(value)
            cond = term if cond is None else cond & term
        return cond
    lo, hi = hr.keys()
    key = F.concat(*[F.col(c) for c in PARTITION_COLUMNS])
    if hr.only is not None:
        return key.isin([h.strftime("%Y%m%d%H") for h in hr.only])
    return key.between(F.lit(lo), F.lit(hi))
