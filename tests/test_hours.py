from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

import pytest

from hourlake.functions.hours import HourRange, hour_glob


def test_parse_single_and_range():
    hr = HourRange.parse("2018-04-06 16")
    assert hr.start == hr.end == datetime(2018, 4, 6, 16)
    hr = HourRange.parse(("2018-04-06 22", "2018-04-07 01"))
    assert len(hr) == 4
    assert hr.keys() == ("2018040622", "2018040701")
    assert HourRange.parse("all").everything
    day = HourRange.parse("2024-02-29")
    assert (day.start, day.end) == (datetime(2024, 2, 29, 0), datetime(2024, 2, 29, 23))
    with pytest.raises(ValueError):
        HourRange.parse(("2018-04-07 01", "2018-04-06 22"))
    with pytest.raises(ValueError):
        HourRange.parse("yesterday")


def test_current_hour_default():
    hr = HourRange.parse(None)
    assert hr.start == hr.end and hr.start.minute == 0


def test_glob_single_hour_plain_and_hive():
    assert hour_glob("/l/", "2018-04-06 16", "plain") == "/l/2018/04/06/16"
    assert hour_glob("/l", "2018-04-06 16", "hive") == "/l/year=2018/month=04/day=06/hour=16"


def test_glob_collapses_full_days_and_months():
    g = hour_glob("/l", ("2024-01-31 22", "2024-02-29 23"), "plain")
    assert g == "/l/{2024/01/31/{22,23},2024/02/[0-9][0-9]/[0-9][0-9]}"
    g = hour_glob("/l", ("2024-03-01 00", "2024-03-02 05"), "hive")
    assert g == ("/l/{year=2024/month=03/day=01/hour=[0-9][0-9],"
                 "year=2024/month=03/day=02/hour={00,01,02,03,04,05}}")


def test_glob_everything():
    assert hour_glob("/l", "all", "plain") == "/l/[0-9][0-9][0-9][0-9]/[0-9][0-9]/[0-9][0-9]/[0-9][0-9]"


def _expand(pattern):
    """Expand {a,b} alternatives (nested) the way Hadoop's glob does."""
    start = pattern.find("{")
    if start < 0:
        return [pattern]
    depth, parts, last = 0, [], start + 1
    for i in range(start, len(pattern)):
        c = pattern[i]
        if c == "{":
            depth += 1
        elif c == "}":
            depth -= 1
            if depth == 0:
                parts.append(pattern[last:i])
                end = i
                break
        elif c == "," and depth == 1:
            parts.append(pattern[last:i])
            last = i + 1
    head, tail = pattern[:start], pattern[end + 1:]
    return [x for p in parts for x in _expand(head + p + tail)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 24 * 800), st.integers(0, 24 * 70), st.sampled_from(["plain", "hive"]))
def test_glob_matches_exactly_the_range(offset, length, layout):
    from fnmatch import fnmatchcase

    base = datetime(2023, 11, 1)
    start, end = base + timedelta(hours=offset), base + timedelta(hours=offset + length)
    pats = _expand(hour_glob("/r", (start.strftime("%Y-%m-%d %H"), end.strftime("%Y-%m-%d %H")), layout))
    universe = [start + timedelta(hours=h) for h in range(-30, length + 30)]

    def folder(h):
        parts = (f"{h:%Y}", f"{h:%m}", f"{h:%d}", f"{h:%H}")
        if layout == "hive":
            parts = tuple(f"{k}={v}" for k, v in zip(("year", "month", "day", "hour"), parts))
        return "/r/" + "/".join(parts)

    matched = [h for h in universe if any(fnmatchcase(folder(h), p) for p in pats)]
    assert matched == [h for h in universe if start <= h <= end]


def test_a_pair_of_days_ends_with_its_last_hour():
    assert len(HourRange.parse(("2024-01-01", "2024-01-31"))) == 744
    assert HourRange.parse(("2024-01-01", "2024-01-01")) == HourRange.parse("2024-01-01")
    assert len(HourRange.parse(("2024-01-01 05", "2024-01-02"))) == 43
