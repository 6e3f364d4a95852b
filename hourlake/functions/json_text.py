"""Column functions over raw JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
# A boundary between two JSON values written back to back (a closing brace or bracket, then
# an opening one, with white space between at most, which JSON never has inside a value),
# found only outside string literals: from where the previous match ended (\G), consume
# plain characters, whole string literals (in double or, as Spark's JSON reader takes
# them, single quotes) and closing signs that no opening one follows; the match
# ends at a closing sign that one does follow.
VALUE_BOUNDARY = (r"""\G((?:[^"'}\]]++|"[^"\\]*+(?:\\.[^"\\]*+)*+"|'[^'\\]*+(?:\\.[^'\\]*+)*+'|[}\]](?!\s*[{\[]))*+[}\]])"""
                  r"""\s*(?=[{\[])""")
# Cheap pre-check: a line can only hold several values back to back if a closing sign comes before an opening one.
MAYBE_SEVERAL = r"[}\]]\s*[{\[]"
# A string literal, an opening brace, or a run of other signs that are no structure: what a document
# holds in the same number however it is spaced, and however many of them share a line or an array.
TOKEN = r"""(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|'[^'\\]*+(?:\\.[^'\\]*+)*+'|\{|[^\s,:{}\[\]"']++"""
# U+0001 never occurs raw in valid JSON text, so it is a safe cut mark.
CUT = "\u0001"
JSON_WHITESPACE = " \t\r\n"


def split_documents(line: Column) -> Column:
    """array<string> of the JSON values written back to back in one line of text.

    Lines holding a single value (JSON lines) skip the full pattern.
    """
    cut = F.split(F.regexp_replace(line, VALUE_BOUNDARY, "$1" + CUT), CUT)
    return F.when(line.rlike(MAYBE_SEVERAL), cut).otherwise(F.array(line))


def strip_json(text: Column) -> Column:
    """``text`` without JSON white space at its ends. Trimming walks through a whole text, so one that begins with an
    opening and ends with a closing sign is left as it is."""
    closed = (text.startswith("{") & text.endswith("}")) | (text.startswith("[") & text.endswith("]"))
    return F.when(closed, text).otherwise(F.btrim(text, F.lit(JSON_WHITESPACE)))


def _texts(array: Column) -> Column:
    """JSON texts of the elements of a JSON array, null if it is none. Through
    VARIANT, which keeps decimals exactly; what it refuses (repeated keys, single
    quotes) goes through strings."""
    exact = F.transform(F.try_variant_get(F.try_parse_json(array), "$", "array<variant>"), lambda e: F.to_json(e))
    plain = F.transform(F.from_json(array, "array<string>"), lambda e: F.coalesce(e, F.lit("null")))
    return F.coalesce(exact, plain)


def _flat(text: Column) -> Column:
    """An object whose only closing brace ends the text: nothing can trail it."""
    return text.startswith("{") & (F.locate("}", text) == F.length(text))


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once. A lambda's body is interpreted, and what stands in it twice is computed
    twice; its argument is not."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _listed(text: Column) -> Column:
    """array<string>: the values of a comma-separated list, null unless the whole text is one.

    The text is read as an array with another array behind it that holds the text's hash. A text
    that closes the array early, so that the reader would stop before its end, does not bring that
    second array with it.
    """
    guard = F.xxhash64(text).cast("string")
    read = F.from_json(F.concat(F.lit("[["), text, F.lit("],["), guard, F.lit("]]")), "array<array<string>>")
    complete = lambda r: (F.size(r) == 2) & (F.get(F.get(r, F.lit(1)), F.lit(0)) == guard)
    return _once(read, lambda r: F.when(complete(r), F.get(r, F.lit(0))))


def is_one_value(doc: Column) -> Column:
    """Whether a text is exactly one JSON value; from_json alone accepts text behind it."""
    text = strip_json(doc)
    return F.when(_flat(text), F.lit(True)).otherwise(F.coalesce(F.size(_listed(text)) == 1, F.lit(False)))


def document_values(fragment: Column, trimmed: bool = False) -> Column:
    """array<struct<doc string, whole boolean>>: the JSON documents of a fragment (``trimmed`` of white space already).

    Values separated by commas are documents each, and a JSON array gives its elements, as Spark's
    JSON reader does. A fragment with anything else before, between or behind its values stays one text
    that is not ``whole``; it is reported as bad, never cut.
    """
    text = fragment if trimmed else strip_json(fragment)
    one = lambda whole: F.array(F.struct(text.alias("doc"), F.lit(whole).alias("whole")))
    elements = lambda value: F.when(value.startswith("["), F.coalesce(_texts(value), F.array(value))) \
        .otherwise(F.array(value))
    several = lambda array: F.transform(array, lambda e: F.struct(e.alias("doc"), F.lit(True).alias("whole")))
    by_count = lambda count: (
        F.when(count < 1, one(False))
        .when(count > 1, F.coalesce(
            several(F.flatten(F.transform(_texts(F.concat(F.lit("["), text, F.lit("]"))), elements))), one(False)))
        .when(text.startswith("["), F.coalesce(several(_texts(text)), one(False)))
        .otherwise(one(True)))
    return F.when(_flat(text), one(True)).otherwise(_once(F.coalesce(F.size(_listed(text)), F.lit(0)), by_count))


def line_documents(line: Column) -> Column:
    """array<struct<doc string, whole boolean>>: the documents of a line without white space at its ends (and so of
    fragments without any: a cut takes the white space around it). A line that is one flat object, as most are, is told before any pattern is tried."""
    one = F.array(F.struct(line.alias("doc"), F.lit(True).alias("whole")))
    return F.when(_flat(line), one).otherwise(
        F.flatten(F.transform(split_documents(line), lambda f: document_values(f, trimmed=True))))


def token_count(text: Column) -> Column:
    """How many names, values and objects a text holds, read without a parser: string literals, opening braces and runs
    of other signs. Arrays, commas and white space count nothing, so a line has as many as its documents together."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("bigint")
