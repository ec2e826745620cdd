"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the number of times that the mix takes it. Among all rates between 0 and
2 with which each source gives its target of words, those nearest to 1 in relative entropy are
chosen. They are exponentially tilted: the rate of a document of s words is exp(a s), at most 2,
with one multiplier a for each source. The multipliers solve the convex dual problem by Newton
steps, kept inside a bracket. A step is one distributed sum: rates depend on source and size
only, so it goes over a stored table of the sizes of each source and how many documents have them,
and the multipliers are a table too. Sums are taken in decimals, which do not depend on the
order of rows, so runs agree to the last digit. A tilt tells sizes apart: a source that must shrink
loses its long documents first, one that must grow repeats them first.

Rates become copies size by size, the largest first: a size's documents get as many copies, rounded, as
bring the words so far nearest to what the rates give. So a source ends within half its
smallest sizes of its target, if it has some small documents. Those copies are dealt
evenly; the documents with the least hash of their id get one more where they do not divide. The
rounding is one task a source, over its different sizes, of which n words have about sqrt(2 n) at
most; ranking goes by shares of a size, whose number and length are the root of its documents'.

Targets: 150 % of all words, shared by weights 3, 1, 2, 3, ... of the sources in code point order, null
last. A target stops at twice its source's words; the rest is shared again among the others.

Defined results: a null text has size 0; documents without words take no words; sources without
words have target 0, and with no words at all all targets are 0. Rows of equal id, source and size are
alike: they get equal numbers of copies, but for one more in some of them. Null ids are such an id.
A text is only measured, however long it is. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

WEIGHTS = (3, 1, 2)
TOTAL, MOST = 1.5, 2
# Words as patterns of the contract have them.
WORD = r"[^\x20\x09-\x0D]+"
# A multiplier is found when its source's words are this near to the target, relatively.
NEAR = 1e-9
STEPS = 100
# Rows of one id, source and size that a task unfolds in one go.
UNFOLD = 10_000
_SUM = "decimal(38,6)"


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def sizes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """``doc_id``, ``source``, ``size`` in words, and ``rows``, the number of rows with the three."""
    size = F.regexp_count(F.coalesce(F.col(text_column), F.lit("")), F.lit(WORD)).cast("long")
    named = docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), size.alias("size"))
    return named.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"))


def _numbered(sources: DataFrame) -> DataFrame:
    """The sources with ``rank``, their place in code point order from 0, null last. Ranges are
    numbered apart and carry on where those before them end."""
    kept = stored(
        sources.repartitionByRange(F.asc_nulls_last("source")).withColumn("range", F.spark_partition_id()), "mix-sources"
    )
    # One row for each range of the shuffle.
    ends = kept.groupBy("range").agg(F.count("*").alias("n"))
    before = ends.select(
        F.col("range").alias("_range"),
        F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    place = F.row_number().over(Window.partitionBy("range").orderBy(F.asc_nulls_last("source")))
    return kept.join(before, F.col("range") == F.col("_range")).select("source", "words", (F.col("before") + place - 1).alias("rank"))


def targets(cells: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """``source``, ``words`` and ``target`` of each source; ``cells`` has source, size and rows."""
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).cast("long").alias("words"))
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod("rank", F.lit(len(weights))).cast("int"))
    weighted = stored(_numbered(sources).select("source", "words", weight.alias("weight")), "mix-weights")
    all_words = weighted.agg(F.sum("words")).first()[0] or 0
    # The level is the words of one unit of weight. Sources that it puts above their greatest
    # target stop there, which raises it for the others, until it puts none above.
    level, known = 0.0, None
    while known is None or level > known:
        known = level
        full = F.col("words") * most <= F.col("weight") * level
        sums = weighted.agg(F.sum(F.when(full, F.col("words"))), F.sum(F.when(~full, F.col("weight").cast("decimal(18,6)")))).first()
        if not sums[1]:
            break
        level = (total * all_words - most * (sums[0] or 0)) / float(sums[1])
    return weighted.select(
        "source", "words", F.least(F.col("words").cast("double") * most, F.col("weight") * level).alias("target")
    )


def _rate(most: float) -> Column:
    """The rate of a cell beside its source's multiplier; null stands for the greatest rate."""
    tilt = F.col("multiplier") * F.col("size") / F.col("scale")
    return F.when(F.col("multiplier").isNull(), F.lit(float(most))).otherwise(F.exp(F.least(tilt, F.lit(math.log(most)))))


def multipliers(cells: DataFrame, wanted: DataFrame, most: float = MOST, steps: int = STEPS) -> DataFrame:
    """``source``, ``scale`` and ``multiplier`` (per ``scale`` words; null for the greatest rate).

    Newton's method for each source's share of the dual, all sources at once. The bracket starts
    open; a step that would leave it halves or doubles instead.
    """
    means = cells.groupBy("source").agg((F.sum(F.col("size") * F.col("rows")) / F.sum("rows")).alias("scale"))
    state = wanted.join(
        means.withColumnRenamed("source", "_of"), _same("source", "_of")
    ).select(
        "source",
        "target",
        F.greatest("scale", F.lit(1.0)).alias("scale"),
        F.when(F.col("target") < F.col("words") * most, 0.0).alias("multiplier"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        (F.col("target") >= F.col("words") * most).alias("found"),
    )
    state = stored(state, "mix-multipliers")
    for _ in range(steps):
        open_ = state.filter("NOT found")
        if open_.isEmpty():
            break
        rate = _rate(most)
        words = F.col("rows") * F.col("size") * rate
        bend = F.when(rate < most, words * F.col("size") / F.col("scale")).otherwise(0.0)
        per_source = (
            cells.join(open_.withColumnRenamed("source", "_of"), _same("source", "_of"))
            .groupBy("source")
            .agg(F.sum(words.cast(_SUM)).cast("double").alias("given"), F.sum(bend.cast(_SUM)).cast("double").alias("bend"))
            .withColumnRenamed("source", "_of")
        )
        over = F.col("given") > F.col("target")
        near = F.abs(F.col("given") - F.col("target")) <= NEAR * F.col("target")
        at = F.col("multiplier")
        low, high = F.when(over, F.col("low")).otherwise(at), F.when(over, at).otherwise(F.col("high"))
        newton = F.when(F.col("bend") > 0, at + (F.col("target") - F.col("given")) / F.col("bend"))
        # Outside the bracket, or without a slope: its middle, or beyond its one known end.
        middle = F.when(low.isNull(), high * 2 - 1).when(high.isNull(), low * 2 + 1).otherwise((low + high) / 2)
        inside = newton.isNotNull() & (low.isNull() | (newton > low)) & (high.isNull() | (newton < high))
        # No double lies between the ends of a bracket that has closed.
        closed = near | (low.isNotNull() & high.isNotNull() & ((middle <= low) | (middle >= high)))
        moved = open_.join(per_source, _same("source", "_of")).select(
            "source",
            "target",
            "scale",
            F.when(closed, at).when(inside, newton).otherwise(middle).alias("multiplier"),
            low.alias("low"),
            high.alias("high"),
            closed.alias("found"),
        )
        state = stored(state.filter("found").unionByName(moved), "mix-multipliers")
    return state.select("source", "scale", "multiplier")


def _rounded(cells: pd.DataFrame) -> pd.DataFrame:
    """Copies of each size of one source; what rounding leaves goes on to the next smaller size."""
    cells = cells.sort_values("size", ascending=False, ignore_index=True)
    aim, taken, copies = 0.0, 0, []
    for size, rows, rate, most in zip(cells["size"].tolist(), cells["rows"].tolist(), cells["rate"].tolist(), cells["most"].tolist(), strict=True):
        aim += rate * rows * size
        n = min(max(math.floor((aim - taken) / size + 0.5), 0), int(most * rows)) if size else rows
        taken += n * size
        copies.append(n)
    return cells.assign(copies=np.array(copies, np.int64))[["source", "size", "rows", "rate", "copies"]]


def _dealt(folded: DataFrame, cells: DataFrame) -> DataFrame:
    """Copies of each row: the cell's, evenly, with one more for those of least rank by id."""
    # A cell's documents are ranked in shares by hash, as many as the root of their number.
    shares = F.ceil(F.sqrt("rows"))
    plan = cells.select(
        F.col("source").alias("_source"),
        F.col("size").alias("_size"),
        "rate",
        F.floor(F.col("copies") / F.col("rows")).alias("each"),
        F.pmod("copies", F.col("rows")).alias("more"),
        F.col("rows").alias("_rows"),
        shares.alias("shares"),
    )
    placed = folded.join(plan, _same("source", "_source") & _same("size", "_size")).withColumn(
        "share", F.pmod(F.xxhash64("doc_id"), F.col("shares"))
    )
    by_cell = Window.partitionBy("source", "size").orderBy("share").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("n").over(by_cell)
    quotas = (
        placed.groupBy("source", "size", "share", "more", "_rows")
        .agg(F.sum("rows").alias("n"))
        .select(
            F.col("source").alias("_of"),
            F.col("size").alias("_at"),
            F.col("share").alias("_share"),
            (
                F.floor(upto.cast("decimal(20,0)") * F.col("more") / F.col("_rows"))
                - F.floor((upto - F.col("n")).cast("decimal(20,0)") * F.col("more") / F.col("_rows"))
            ).cast("long").alias("quota"),
        )
    )
    by_share = Window.partitionBy("source", "size", "share").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")
    before = F.coalesce(F.sum("rows").over(by_share.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = placed.join(quotas, _same("source", "_of") & _same("size", "_at") & _same("share", "_share")).withColumn(
        "first", F.greatest(F.lit(0), F.least("rows", F.col("quota") - before))
    )
    # Rows of one id, source and size are unfolded in pieces, so that no list of them is long.
    pieces = ranked.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(rows - 1) div {UNFOLD}"))))
    until = F.least(F.col("rows"), (F.col("piece") + 1) * UNFOLD) - 1
    unfolded = pieces.withColumn("k", F.explode(F.sequence(F.col("piece") * UNFOLD, until)))
    return unfolded.select(
        "doc_id", "source", "size", "rate", (F.col("each") + (F.col("k") < F.col("first")).cast("long")).alias("copies")
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    total: float = TOTAL,
    most: int = MOST,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``rate`` and ``copies`` of each row:
    how often the mix takes it."""
    if not 0 < total <= most:
        raise ValueError(f"a mix of {total} times all words cannot be had with {most} copies at most")
    folded = stored(sizes(docs, id_column, text_column, source_column), "mix-sizes")
    cells = stored(folded.groupBy("source", "size").agg(F.sum("rows").alias("rows")), "mix-cells")
    wanted = stored(targets(cells, weights, total, most), "mix-targets")
    found = multipliers(cells, wanted, most).withColumnRenamed("source", "_of")
    rated = cells.join(found, _same("source", "_of")).select(
        "source", "size", "rows", _rate(most).alias("rate"), F.lit(int(most)).alias("most")
    )
    schema = rated.drop("most").schema.add("copies", "long")
    copies = stored(rated.groupBy("source").applyInPandas(_rounded, schema), "mix-copies")
    named = wanted.select(F.col("source").alias("_of"), F.col("words").alias("source_size"), "target")
    dealt = _dealt(folded, copies).join(named, _same("source", "_of"))
    return dealt.select("doc_id", "source", "size", "source_size", "target", "rate", "copies")


def repeated(docs: DataFrame, mixed: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The mixed documents themselves, each as often as the mix takes it. Ids must be unique."""
    taken = mixed.filter("copies > 0").select(F.col("doc_id").alias("_id"), "copies")
    joined = docs.join(taken, _same(id_column, "_id"))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*docs.columns)


def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{folder}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "rate", "copies")
