"""Mixing sources to target weights by entropy balancing, in DataFrame operations alone.

Document rates closest to 1 in relative entropy, whose words meet every source's target, are
``min(most, exp(lambda * size / mean))`` with one multiplier per source: the convex dual's optimum. Newton
steps on all multipliers at once are one grouped sum over (source, size) counts each, held inside a
bracket. Sums are decimals, so neither row order nor a retried task changes them, and reruns agree.

Rates become copies by systematic rounding inside bounded groups of a source's documents, largest first.
Then single documents whose size is nearest to what a source still lacks (or has over) gain or lose a copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm.chunks import save

MOST = 3
GROUP_ROWS = 2000
ROUNDS = 60
FIXES = 10


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target) for rows of (source, size).

    Sources in code point order, null last, weigh 1, 2, 3 in turn and share the total of all sizes. A target stops
    at ``most`` times its source's size and the excess goes to the others by weight: target = min(cap, level * weight)
    for the greatest level (cap passed out so far taken off) / (weight left). Windows here run over one row a source.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    sums = sums.withColumn("weight", (rank - 1) % 3 + 1).withColumn("cap", F.col("source_size") * most)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total - F.sum("cap").over(by_level) + F.col("cap")) / (
        F.sum("weight").over(Window.partitionBy()) - F.sum("weight").over(by_level) + F.col("weight"))
    level = F.max(level).over(Window.partitionBy())
    return sums.withColumn("level", F.coalesce(level.cast("double"), F.lit(0.0))).select(
        "source", "source_size", "weight",
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))



def _rate(size: Column, tilt: Column, mean: Column, most: int) -> Column:
    """min(most, exp(tilt * size / mean)); the argument is bounded first, so nothing overflows."""
    return F.least(F.lit(float(most)), F.exp(F.least(tilt * size / mean, F.lit(float(most)))))


def tilts(sizes: DataFrame, goal: DataFrame, most: int = MOST) -> DataFrame:
    """``goal`` with each source's multiplier ``tilt`` and the mean size ``mean`` that scales it."""
    counts = save(sizes.where("size > 0").groupBy(F.col("source").alias("s"), "size").agg(F.count("*").alias("n")), "sizes")
    mean = counts.agg(F.sum(F.col("size") * F.col("n")) / F.sum("n")).first()[0] or 1.0
    state = save(goal.select("*", F.lit(float(mean)).alias("mean"), F.lit(0.0).alias("tilt"),
                             F.lit(-1e9).alias("lo"), F.lit(1e9).alias("hi"),
                             (F.col("target") <= 0).alias("done")), "tilt")
    exact = lambda x: F.sum(x.cast("decimal(30,8)")).cast("double")
    for _ in range(ROUNDS):
        size, rate = F.col("size").cast("double"), _rate(F.col("size").cast("double"), F.col("tilt"), F.col("mean"), most)
        words = F.col("n") * size * rate
        sums = counts.join(state.where("not done").select(F.col("source").alias("t"), "tilt", "mean"),
                           F.col("s").eqNullSafe(F.col("t"))).groupBy(F.col("t").alias("g")).agg(
            exact(words).alias("have"),
            exact(F.when(rate < most, words * size / F.col("mean")).otherwise(0.0)).alias("slope"))
        over = F.col("have") - F.col("target")
        lo = F.when(over < 0, F.col("tilt")).otherwise(F.col("lo"))
        hi = F.when(over > 0, F.col("tilt")).otherwise(F.col("hi"))
        newton = F.col("tilt") - over / F.col("slope")
        # Outside the bracket: its middle, or twice as far while an end is still open.
        inside = (newton > F.col("lo")) & (newton < F.col("hi")) & (F.col("slope") > 0)
        wide = F.when(F.col("hi") >= 1e9, F.greatest(F.col("lo") * 2, F.lit(1.0))).when(
            F.col("lo") <= -1e9, F.least(F.col("hi") * 2, F.lit(-1.0))).otherwise((F.col("lo") + F.col("hi")) / 2)
        close = F.abs(over) <= F.greatest(F.col("target") * 1e-10, F.lit(1e-6))
        held = state.join(sums, F.col("source").eqNullSafe(F.col("g")), "left")
        held = held.withColumn("stop", F.col("done") | F.col("have").isNull() | close
                               | (F.col("hi") - F.col("lo") < 1e-13) | (F.col("tilt") >= 1e8))
        held = held.withColumn("lo", F.when(F.col("stop"), F.col("lo")).otherwise(lo)).withColumn(
            "hi", F.when(F.col("stop"), F.col("hi")).otherwise(hi))
        held = held.withColumn("tilt", F.when(F.col("stop"), F.col("tilt")).when(inside, newton).otherwise(wide))
        state = save(held.withColumn("done", F.col("stop")).select(state.columns), "tilt")
        if not state.where("not done").limit(1).count():
            break
    return state.drop("lo", "hi", "done")


def mix(docs: DataFrame, most: int = MOST) -> DataFrame:
    """Copies of every document: doc_id, source, sig (hash of its text), size, source_size, target, rate, copies, taken.

    ``docs`` needs doc_id, source and text; other columns are not read. A null or empty text has size 0 and is
    never taken; a null source is a source, the last; rows that repeat are documents of their own (equal
    ones differ at most in their copies); an empty table gives no rows.
    """
    rows = save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                            F.xxhash64("text").alias("sig"), word_count(F.col("text")).alias("size"))
                .withColumn("row", F.monotonically_increasing_id()), "sizes")
    goal = tilts(rows, save(targets(rows, most), "targets"), most)
    counts = rows.groupBy(F.col("source").alias("s")).agg(F.count("*").alias("docs"))
    goal = goal.join(counts, F.col("source").eqNullSafe(F.col("s"))).withColumnRenamed("source", "g").drop("s")
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("target") <= 0, 0.0).otherwise(
        _rate(F.col("size").cast("double"), F.col("tilt"), F.col("mean"), most))
    rated = rows.join(goal, F.col("source").eqNullSafe(F.col("g"))).withColumn("rate", rate)
    # 2**30ths, so that running sums are whole numbers.
    fine = F.round(F.col("rate") * (1 << 30)).cast("long")
    groups = F.ceil(F.col("docs") / GROUP_ROWS)
    rated = rated.withColumn("fine", fine).withColumn("group", F.pmod(F.xxhash64("doc_id", "sig"), groups))
    running = F.sum("fine").over(Window.partitionBy("source", "group").orderBy(
        F.desc("size"), "doc_id", "sig", "row").rowsBetween(Window.unboundedPreceding, 0))
    half = F.lit(1 << 29)
    whole = lambda x: F.floor((x + half) / F.lit(1 << 30))
    copies = F.least(F.lit(most), F.greatest(F.lit(0), whole(running) - whole(running - F.col("fine")))).cast("long")
    rounded = save(rated.withColumn("copies", copies).select(
        "row", "doc_id", "source", "sig", "size", "source_size", "target", "rate", "copies"), "copies")
    fixes = _fix(rounded, most)
    out = rounded.join(fixes, "row", "left").withColumn("copies", F.col("copies") + F.coalesce("change", F.lit(0)))
    return out.withColumn("taken", F.col("copies") * F.col("size")).drop("row", "change")


def _fix(rounded: DataFrame, most: int) -> DataFrame:
    """(row, change): per source and round, one copy more or less of the document nearest in size to what is amiss."""
    lacks = save(rounded.groupBy(F.col("source").alias("g")).agg(
        (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("lack")), "lacks")
    fixes = save(rounded.select("row", F.lit(0).cast("long").alias("change")).limit(0), "fixes")
    for _ in range(FIXES):
        may = F.when(F.col("lack") > 0, F.col("copies") + F.coalesce("change", F.lit(0)) < most).otherwise(
            F.col("copies") + F.coalesce("change", F.lit(0)) > 0)
        near = F.abs(F.abs("lack") - F.col("size"))
        picks = (rounded.join(fixes, "row", "left").join(lacks, F.col("source").eqNullSafe(F.col("g")))
                 .where(may & (F.col("size") > 0) & (near < F.abs("lack")))
                 .groupBy("g").agg(F.min(F.struct(near.alias("near"), "doc_id", "sig", "row", "size", "lack")).alias("p")))
        picks = save(picks.select("g", "p.row", "p.size", F.signum("p.lack").cast("long").alias("change")), "picks")
        if not picks.limit(1).count():
            break
        fixes = save(fixes.unionByName(picks.select("row", "change")).groupBy("row").agg(F.sum("change").alias("change")), "fixes")
        moved = picks.select(F.col("g").alias("m"), (F.col("change") * F.col("size")).alias("moved"))
        lacks = save(lacks.join(moved, F.col("g").eqNullSafe(F.col("m")), "left").select(
            "g", (F.col("lack") - F.coalesce("moved", F.lit(0))).alias("lack")), "lacks")
    return fixes


def repeat(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``docs`` with every document as often as :func:`mix` says.

    Rows that share id, source and text share their copies too: in the order of their other columns each kind of row
    gets its part of them, by how many such rows there are, and none takes the place of another.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    same = ["doc_id", "source", "_sig"]
    marked = docs.withColumn("_sig", F.xxhash64("text")).withColumn(
        "_rest", F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest]))) if rest else F.lit(0).cast("long"))
    kinds = marked.groupBy(*same, "_rest").agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(*same)
    upto = F.sum("n").over(every.orderBy("_rest").rowsBetween(Window.unboundedPreceding, 0))
    kinds = kinds.select(*[F.col(c).alias(f"k_{c}") for c in (*same, "_rest")], "n", upto.alias("upto"), F.sum("n").over(every).alias("of"))
    copies = mixed.groupBy("doc_id", "source", "sig").agg(F.sum("copies").alias("copies")).where("copies > 0")
    shared = kinds.join(copies, F.col("k_doc_id").eqNullSafe(F.col("doc_id")) & F.col("k_source").eqNullSafe(F.col("source")) & (F.col("k__sig") == F.col("sig")))
    part = F.floor(F.col("copies") * F.col("upto") / F.col("of")) - F.floor(F.col("copies") * (F.col("upto") - F.col("n")) / F.col("of"))
    shared = shared.select(*[f"k_{c}" for c in (*same, "_rest")], part.cast("int").alias("_copies")).where("_copies > 0")
    one = marked.dropDuplicates([*same, "_rest"])
    joined = one.join(shared, F.col("doc_id").eqNullSafe(F.col("k_doc_id")) & F.col("source").eqNullSafe(F.col("k_source"))
                      & (F.col("_sig") == F.col("k__sig")) & (F.col("_rest") == F.col("k__rest")))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(docs.columns)
