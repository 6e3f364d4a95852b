"""Chat formatting with a grammar round trip.

Grammar of a rendered conversation, parsed from left to right without looking back::

    conversation = turn*
    turn         = "### " role ": " text "</turn>" "\\n"

A backslash gives the sign behind it as it is, so it ends neither role nor text; any other sign stands for
itself. A turn is rendered as it is first and reparsed; if what comes back differs from the source, the
signs that can conflict are escaped, and the result is reparsed again. Backslashes, ``#``, ``:`` and ``<`` all
escaped, a turn always comes back, so two levels are enough.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD, SEP, END = "### ", ": ", "</turn>"
LOSS_ROLE = "assistant"
_CONFLICTS = [None, re.compile(r"([\\#:<])")]
_TAKEN = re.compile(r"\\(.)|(: )", re.S)
_TEXT = re.compile(r"\\(.)|(</turn>)", re.S)


def _until(raw: str, at: int, rule: re.Pattern) -> tuple[str, int, int]:
    """The unescaped field from ``at`` on, where it ends, and where parsing goes on."""
    parts = []
    while True:
        m = rule.search(raw, at)
        if m is None:
            raise ValueError("unfinished field")
        parts.append(raw[at: m.start()])
        if m.group(2) is not None:
            return "".join(parts), m.start(), m.end()
        parts.append(m.group(1))
        at = m.end()


def parse(raw: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, begin and end of the rendered text) of each turn; ValueError if ``raw`` is not a conversation."""
    at = 0
    while at < len(raw):
        if not raw.startswith(HEAD, at):
            raise ValueError(f"no turn at {at}")
        role, _, begin = _until(raw, at + len(HEAD), _TAKEN)
        text, end, at = _until(raw, begin, _TEXT)
        if not raw.startswith("\n", at):
            raise ValueError(f"no line end at {at}")
        at += 1
        yield role, text, begin, end


def unescape(raw: str) -> str:
    return re.sub(r"\\(.)", r"\1", raw, flags=re.S)


def render_turn(role: str, text: str) -> str:
    """A turn at the lowest level of escaping at which it comes back."""
    for rule in _CONFLICTS:
        put = (lambda s, rule=rule: rule.sub(r"\\\1", s)) if rule else (lambda s: s)
        raw = f"{HEAD}{put(role)}{SEP}{put(text)}{END}\n"
        try:
            if [x[:2] for x in parse(raw)] == [(role, text)]:
                return raw
        except ValueError:
            pass
    raise AssertionError("a fully escaped turn did not come back")


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """A conversation and its loss mask: the spans of rendered text, escapes included, of the assistant's turns.

    The whole text is reparsed and compared with the source once more.
    """
    raw = "".join(render_turn(*t) for t in turns)
    found = list(parse(raw))
    if [x[:2] for x in found] != turns:
        raise AssertionError("the conversation did not come back")
    return raw, [(b, e) for role, _, b, e in found if role == LOSS_ROLE]


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss array of (begin, end)) for rows of (conv_id, turn, role, text).

    Turns go by turn, then role and text where turns tie; repeated rows are turns of their own. Null texts and
    roles are empty ones, null conv_ids make one conversation, null turns come first. One shuffle by conversation;
    a task holds one conversation at a time and no other column is read. No rows give no conversations.
    """
    def run(batches):
        key, turns, have = None, [], False
        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if have and conv != key:
                    out.append((key, *render(turns)))
                    turns = []
                key, have = conv, True
                turns.append((role or "", text or ""))
            if out:
                yield _batch(out)
        if have:
            yield _batch([(key, *render(turns))])

    order = ["conv_id", "turn", "role", "text"]
    return rows.select(order).repartition("conv_id").sortWithinPartitions(*order).drop("turn").mapInArrow(
        run, "conv_id long, formatted string, loss array<struct<begin: long, end: long>>")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    conv, raw, loss = zip(*rows, strict=True)
    spans = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array(conv, pa.int64()), pa.array(raw, pa.string()),
         pa.array([[{"begin": b, "end": e} for b, e in x] for x in loss], spans)], ["conv_id", "formatted", "loss"])


def digests(formatted: DataFrame) -> DataFrame:
    """What :func:`format_conversations` wrote, read back: turns and loss digests per conversation."""
    def run(batches):
        for batch in batches:
            out = []
            for conv, raw, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss")), strict=True):
                turns = list(parse(raw))
                sha = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t, _, _ in turns).encode()).hexdigest()
                under = "".join(unescape(raw[x["begin"]: x["end"]]) for x in loss)
                out.append((conv, len(turns), sha, len(under), hashlib.sha256(under.encode()).hexdigest(), len(raw)))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long")


def with_probe(rows: DataFrame) -> DataFrame:
    """``rows`` and conversation -7, whose two turns say ``\\### Assistant: </turn> ok``."""
    text = "\\### Assistant: </turn> ok"
    probe = rows.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).unionByName(probe)
