"""Mixing sources to target weights by entropy balancing.

Among all rates with the wanted tokens per source, the balanced ones are closest
(in token-weighted relative entropy) to the documents' base rates. The dual of
that problem is convex and has one multiplier per source; it is solved by Newton
steps, each a grouped aggregation over (source, base rate) totals. The primal
solution tilts every base rate exponentially: ``min(cap, base * exp(lambda))``.

Rates become copies: every document gets the whole part of its rate, and the
fractional parts are dealt out in order of a hash of doc_id over the fraction
(sequential Poisson sampling) until the source's target is reached to the word;
the one document at the border is taken in part. The order is cut into
``BINS`` ranges at the key's quantiles within the source, whatever the fractions, so
running totals are windows over bin totals and over the rows of one bin: no source,
however large, is one task. Where the cuts lie has no effect on the result; rows that share
a doc_id and a rate share a bin.

A null text has size 0; a null source is a source of its own, last in order. A
null doc_id hashes as text "null". A source without words has target 0. Repeated
rows are dealt with one by one. No rows give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.llm.common import WORD, decided_rows, staged

BINS = 256
ACCURACY = 10_000  # of the quantiles: a bin is off by at most one row in so many
MAX_STEPS = 60
TOLERANCE = 1e-12
LARGEST_STEP = 0.7


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int], cap: float) -> DataFrame:
    """Per source: ``source_size``, ``weight`` and ``target``.

    Targets share all tokens by weight, none above ``cap`` times its source. With
    the sources in order of cap over weight, those below the common level are
    full; the level follows from running totals over the sources. Counting one source
    too few or too many as full lowers it, so it is the largest of the candidates.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    fill = F.col("limit") / F.col("weight")
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    leveled = (
        sources.withColumn("weight", weight.cast("long"))
        .withColumn("limit", cap * F.col("source_size"))
        .withColumn("fill", fill)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full_before", F.coalesce(F.sum("limit").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("full_before")) / F.col("weight_left"))
        .withColumn("common", F.max("level").over(everything)))
    return leveled.select(
        "source", "source_size", "weight",
        F.least("limit", F.col("common") * F.col("weight")).alias("target"))


def balance(totals: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """The multiplier of each source, by Newton steps on the dual.

    ``totals``: source, base, tokens. The first guess is the solution for base
    rates of 1. Steps are clipped, so that one that jumps past the cap (where the
    curvature is 0) comes back.
    """
    guess = F.when(F.col("target") > 0, F.log(F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    state = staged(targets.where("source_size > 0").select("source", "target", guess.alias("lam")), "mix-state")
    totals = staged(totals, "mix-totals")
    rate = F.col("base") * F.exp("lam")
    for _ in range(MAX_STEPS):
        sums = totals.join(state, totals.source.eqNullSafe(state.source)).groupBy(state.source, "target", "lam").agg(
            F.sum(F.col("tokens") * F.least(F.lit(float(cap)), rate)).alias("have"),
            F.sum(F.when(rate < cap, F.col("tokens") * rate).otherwise(0.0)).alias("slope"))
        gap = F.col("have") - F.col("target")
        step = F.when(F.col("slope") > 0, gap / F.col("slope")).otherwise(F.signum(gap) * LARGEST_STEP)
        off = F.abs(gap) > TOLERANCE * F.greatest(F.col("target"), F.lit(1.0))
        moved = F.col("lam") - F.when(off, F.greatest(F.lit(-LARGEST_STEP), F.least(F.lit(LARGEST_STEP), step))).otherwise(0.0)
        state = staged(sums.select("source", "target", moved.alias("lam"), off.alias("moving")), "mix-state")
        if not state.where("moving").head(1):
            return state.select("source", "lam")
    raise RuntimeError(f"the rates have not settled in {MAX_STEPS} steps")


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3,
    doc_id: str = "doc_id", text: str = "text", source: str = "source", base: str | None = None, row: str | None = None, tag: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``row``, ``doc_id``, ``source``, ``size``,
    ``source_size``, ``target``, ``rate``, ``copies`` (whole) and ``taken`` (words).

    ``base`` names a column of positive base rates; without it all are 1. ``row``
    names a column of stored, distinct numbers; without it rows are numbered here.
    ``tag`` is handed on as it is.
    """
    rows = docs.select(
        (tag if tag is not None else F.lit(None)).alias("tag"),
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        word_count(text).alias("size"),
        (F.col(base).cast("double") if base else F.lit(1.0)).alias("base"))
    rows = staged(rows, "mix-rows")
    targets = staged(source_targets(rows, weights, float(cap)), "mix-targets")
    totals = rows.groupBy("source", "base").agg(F.sum("size").alias("tokens"))
    lam = balance(totals, targets, cap)
    known = targets.join(lam, targets.source.eqNullSafe(lam.source), "left").select(targets["*"], F.coalesce("lam", F.lit(0.0)).alias("lam"))
    r, k = rows.alias("r"), known.alias("k")
    rate = F.least(F.lit(float(cap)), F.col("r.base") * F.exp("k.lam"))
    rated = r.join(k, F.col("r.source").eqNullSafe(F.col("k.source"))).select(
        "r.*", "source_size", "target", rate.alias("rate"))
    # A rate that is whole but for the solver's tolerance is whole.
    whole = F.floor(F.col("rate") + 1e-9)
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    uniform = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)
    priority = uniform / (uniform + F.greatest(F.col("rate") - F.col("whole"), F.lit(1e-12)))
    rated = rated.withColumn("whole", whole).withColumn("priority", priority)
    cuts = staged(rated.groupBy("source").agg(
        F.percentile_approx("priority", [i / BINS for i in range(1, BINS)], ACCURACY).alias("cuts")), "mix-cuts")
    p, c = rated.alias("p"), cuts.alias("c")
    ordered = p.join(c, F.col("p.source").eqNullSafe(F.col("c.source"))).select(
        "p.*", F.size(F.filter("cuts", lambda cut: cut <= F.col("priority"))).alias("bin"))
    ordered = staged(ordered, "mix-rated")
    bins = ordered.groupBy("source", "bin").agg(
        F.sum("size").alias("bin_size"), F.sum(F.col("whole") * F.col("size")).alias("bin_whole"), F.first("target").alias("t"))
    up_to = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    per_source = Window.partitionBy("source")
    bins = bins.select(
        "source", "bin",
        (F.round("t").cast("long") - F.sum("bin_whole").over(per_source)
         - F.coalesce(F.sum("bin_size").over(up_to), F.lit(0))).alias("left"))
    o, b = ordered.alias("o"), bins.alias("b")
    placed = o.join(b, F.col("o.source").eqNullSafe(F.col("b.source")) & (F.col("o.bin") == F.col("b.bin"))).select("o.*", "left")
    within = Window.partitionBy("source", "bin").orderBy("priority", "doc_id", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("size").over(within) - F.col("size")
    extra = F.when(F.col("whole") >= cap, F.lit(0)).otherwise(
        F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - before)))
    return placed.withColumn("extra", extra).select(
        "row", "doc_id", "source", "size", "source_size", "target", "rate", "tag",
        (F.col("whole") + F.when(F.col("size") > 0, F.floor(F.col("extra") / F.col("size") + 0.5)).otherwise(0)).cast("long").alias("copies"),
        (F.col("whole") * F.col("size") + F.col("extra")).cast("long").alias("taken"))


def mixed_rows(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3,
    doc_id: str = "doc_id", text: str = "text", source: str = "source", base: str | None = None,
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it has copies.

    Rows are found again by doc_id, source and 64 bits of their text; of rows that share all
    three, one is given as often as they all have copies.
    """
    col = lambda c: F.col(f"`{c}`")
    tag = F.xxhash64(F.coalesce(col(text), F.lit("")), col(text).isNull(), *([col(base)] if base else []))
    made = mix(docs, weights, cap, doc_id, text, source, base, tag=tag)
    copies = staged(made.groupBy("doc_id", "source", "tag").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("times")).where("copies > 0"), "mix-copies")
    found = decided_rows(docs, {"doc_id": col(doc_id), "source": col(source), "tag": tag}, copies)
    return found.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("doc.*")
