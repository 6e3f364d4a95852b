"""Parsing JSON documents against a schema, with bad records set aside."""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions.hours import PARTITION_COLUMNS
from hourlake.functions.json_text import is_one_value, strip_json
from hourlake.operators.schema import common_schema
from hourlake.session import scratch_dir
from hourlake.sources.landing import SOURCE_FILE, WHOLE

CORRUPT = "_corrupt_record"
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")

# Timestamps are written and read with microseconds; Spark's
# default JSON timestamp format stops at milliseconds.
TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"


def as_struct(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return T.StructType([f for f in schema.fields if f.name != CORRUPT])


def output_struct(schema: T.StructType | str, clash_suffix: str | None = None) -> T.StructType:
    """The published fields of ``schema``: those named like an hour key get ``clash_suffix``
    behind their name; without one they are an error."""
    struct = as_struct(schema)
    taken = PARTITION_COLUMNS + (SOURCE_FILE, WHOLE)
    clash = [f.name for f in struct.fields if f.name.lower() in taken]
    if clash and not clash_suffix:
        raise ValueError(f"record fields {clash} collide with the hour partition columns; "
                         "name a clash_suffix to publish them under another name")
    names = [f.name + (clash_suffix if f.name.lower() in taken else "") for f in struct.fields]
    twice = {n for n in names if names.count(n) > 1}
    if twice:
        raise ValueError(f"record fields {sorted(twice)} would have the same name")
    return T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, struct.fields)])


def json_options(extra: dict | None = None) -> dict:
    opts = {"timestampNTZFormat": TIMESTAMP_NTZ_FORMAT}
    opts.update(extra or {})
    return opts


def parse_documents(docs: DataFrame, schema: T.StructType | str, mode: str = "PERMISSIVE",
                    options: dict | None = None, clash_suffix: str | None = None) -> DataFrame:
    """Parse ``doc`` with ``schema``; every record keeps its hour and file.

    PERMISSIVE keeps bad records with all fields null and their text in
    ``_corrupt_record``; DROPMALFORMED drops them; FAILFAST fails the task
    (and so the job) on the first one. A document is bad when it does not
    parse, when a value does not fit its declared type, or when it is not
    exactly one JSON value (``from_json`` alone accepts text behind it).
    ``clash_suffix``: see :func:`output_struct`.
    """
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    struct, names = as_struct(schema), output_struct(schema, clash_suffix).names
    with_corrupt = T.StructType(struct.fields + [T.StructField(CORRUPT, T.StringType())])
    opts = json_options(options)
    opts.update({"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    keep = [c for c in docs.columns if c not in ("doc", WHOLE)]
    # What documents() cut has no white space at its ends.
    cut = WHOLE in docs.columns
    whole = F.col(WHOLE) if cut else is_one_value(F.col("doc"))
    text = F.col("doc") if cut else strip_json(F.col("doc"))
    # Filters on the result must stay above the parse: the optimizer copies a plain column's expression into
    # every filter it pushes down, and would parse each document several times. It does not push
    # filters below a column that depends on where a row is, as the (always true) last condition does.
    parsed = docs.select("doc", F.from_json(F.col("doc"), with_corrupt, opts).alias("_r"), whole.alias("_whole"), *keep)
    record = F.col("_r")
    ok: Column = record.isNotNull() & record.getField(CORRUPT).isNull() & F.col("_whole") & text.startswith("{")
    parsed = parsed.select("doc", (ok & (F.spark_partition_id() >= 0)).alias("_ok"), "_r", *keep)
    ok = F.col("_ok")
    fields = [F.when(ok, record.getField(f.name)).alias(n) for f, n in zip(struct.fields, names)]
    bad_text = F.when(ok, F.lit(None).cast("string")).otherwise(F.col("doc"))
    if mode == "FAILFAST":
        where = F.coalesce(F.col(SOURCE_FILE), F.lit("?")) if SOURCE_FILE in keep else F.lit("?")
        bad_text = F.when(ok, F.lit(None).cast("string")).otherwise(
            F.raise_error(F.concat(F.lit("malformed JSON record in "), where, F.lit(": "),
                                   F.substring(F.col("doc"), 1, 200))))
    out = parsed.select(*fields, bad_text.alias(CORRUPT), *keep)
    if mode == "DROPMALFORMED":
        out = out.where(F.col(CORRUPT).isNull())
    return out


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT, SOURCE_FILE)


def bad_records(parsed: DataFrame) -> DataFrame:
    keep = [c for c in (SOURCE_FILE, *PARTITION_COLUMNS) if c in parsed.columns]
    return parsed.where(F.col(CORRUPT).isNotNull()).select(*keep, CORRUPT)


# Reader options that change inference; with any of them the reader infers.
_READER_ONLY = ("inferTimestamp", "prefersDecimal", "primitivesAsString", "allowNumericLeadingZeros")
# Fixed value: the name that schema_of_variant_agg prints for a struct.
_OBJECT = "OBJECT<"


def _json_type(kind: T.DataType) -> T.DataType | None:
    """The type Spark's JSON reader infers for a VARIANT's: mixed types and null-only values
    become strings, numbers with a fraction doubles; what holds no field is no column."""
    if isinstance(kind, T.StructType):
        fields = [T.StructField(f.name, t) for f in kind.fields if (t := _json_type(f.dataType)) is not None]
        return T.StructType(fields) if fields else None
    if isinstance(kind, T.ArrayType):
        element = _json_type(kind.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(kind, (T.VariantType, T.NullType)):
        return T.StringType()
    if isinstance(kind, T.DecimalType) and kind.scale:
        return T.DoubleType()
    return kind


def _variant_struct(printed: str) -> T.StructType:
    """The printed type as a struct. Names may hold anything between backquotes."""
    ddl = re.sub(r"`(?:[^`]|``)*`|" + _OBJECT, lambda m: "STRUCT<" if m[0] == _OBJECT else m[0], printed)
    return _json_type(T.StructType([T.StructField("r", T._parse_datatype_string(ddl))])) or T.StructType([])


@contextmanager
def _last_of_repeated_keys(spark: SparkSession):
    """VARIANT parses made inside keep the last of repeated keys instead of refusing the document."""
    key = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _reader_schema(docs: DataFrame, options: dict | None) -> T.StructType:
    """What ``DataFrameReader.json`` infers, over the documents written as lines."""
    path = scratch_dir(docs.sparkSession, "infer")
    docs.select(F.col("doc").alias("value")).write.text(path)
    found = docs.sparkSession.read.options(**json_options(options)).option("mode", "DROPMALFORMED").json(path)
    return T.StructType([f for f in found.schema.fields if f.name != CORRUPT])


def infer_schema(docs: DataFrame, sampling_ratio: float = 1.0, options: dict | None = None,
                 seed: int = 7) -> T.StructType:
    """The schema Spark's JSON reader would infer for the split documents.

    Runs as one native aggregate (``schema_of_variant_agg`` over
    ``try_parse_json``), partially aggregated on the map side, so inference
    is a scan with no Python and no per-document driver work. Columns that
    drift between files are merged by name, fields sorted by name; a column
    whose types disagree widens as the reader widens (integers with
    fractions to double, anything mixed with text, booleans or objects to
    string); malformed documents and values that are no objects are skipped.
    Documents that VARIANT refuses and the reader takes (single quotes) are
    inferred by the reader, and so is everything with options only it knows. Of
    repeated keys the last counts, as in the parse. Every document is looked at unless ``sampling_ratio`` says less:
    then fields found in none of the sampled documents are not published.
    """
    if WHOLE in docs.columns:
        sample = docs.where(F.col(WHOLE) & F.col("doc").startswith("{")).select("doc")
    else:
        sample = docs.where(is_one_value(F.col("doc")) & strip_json(F.col("doc")).startswith("{")).select("doc")
    if sampling_ratio < 1.0:
        sample = sample.sample(False, sampling_ratio, seed)
    if any(k in (options or {}) for k in _READER_ONLY):
        return _reader_schema(sample, options)
    variant = F.try_parse_json("doc")
    with _last_of_repeated_keys(docs.sparkSession):
        printed, documents, read = sample.agg(
            F.schema_of_variant_agg(variant), F.count(F.lit(1)), F.count(variant)).first()
    found = []
    if read:
        record = [f.dataType for f in _variant_struct(printed).fields]
        found += [t for t in record if isinstance(t, T.StructType)]
    if read < documents:
        with _last_of_repeated_keys(docs.sparkSession):
            found.append(_reader_schema(sample.where(variant.isNull()), options))
    fields = common_schema(found).fields if found else []
    return T.StructType(sorted((f for f in fields if f.name != CORRUPT), key=lambda f: f.name))
