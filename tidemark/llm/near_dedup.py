"""Near duplicates by one-permutation MinHash.

A text's set is its distinct shingles of ``SHINGLE`` words. One hash per shingle gives both its bin
and its rank there; the least of each bin is the signature, and an empty bin takes the value of
the first non-empty bin on a fixed random path (optimal densification). Bands of the signature
name buckets. In a bucket, candidate edges run only from a centre to the members, so their number
follows the bucket's size, not its square: first from the member that shares most buckets with
others, which in a group of edited copies is what they were copied from; then, in buckets whose
members are still in different components, from a few centres drawn at random, for pairs in
different components alone. What hot buckets still hold in several components is searched by prefix
filter: the shingles of those texts are ordered by how many of them hold each, and two texts that
reach the similarity share one among the first few of either. Of candidates with ``WHOLE`` or more shingles each, those
whose signatures agree too little are dropped (a true link is lost so with a chance below one in a
million); all others, and all pairs with a smaller set, whose bins repeat few shingles and so agree more or
less by chance, are compared by their full sets.

Equal sets are one node, so copies cost a row each and no edge. A node is named by a 64-bit hash
of its set. Sums are folded per task before each shuffle and stand in tables of their own when
they are joined back, so hot buckets and hot texts can be split. Nothing is collected to the
driver but counts.

Defined results: a text of fewer words than a shingle is one shingle of all its words; a null or
empty text has an empty set and is its own component; rows of one id and text share their result;
a component's id ignores null ids unless it has no other; of texts with equal sets that with the least
id stands for the others, and of members with equally many shared buckets the one with the greatest hash is the
centre, which changes the pairs looked at and no link; a very long text is one set, made in one pass over all of its
words; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, mix, prefix_hash, row_slices, run_hash, settled, stored, text_bytes, words_of

SHINGLE = 4
SIMILAR = 80  # percent
BINS = 128
BANDS = 32
# Bins that must agree before two sets are compared: of 128 independent ones that agree at 80 percent each, fewer do
# with a chance below one in a million.
AGREE = 78
# Sets with fewer shingles than this skip that filter.
WHOLE = 64
# Centres that a bucket is expected to draw after its first one.
DRAWN = 3

_RANK = np.uint64(53)  # bits of a shingle's hash; the rest of a sort key holds its row
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(raw: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts, ascending in each text, and where each text's begin."""
    raw = _LOWER[raw]
    begin, end, before = words_of(raw, starts, _WORD)
    words = run_hash(prefix_hash(raw), begin, end)
    count = np.diff(before)
    number = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(len(count)), number)
    first = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number) + before[:-1][row]
    last = np.minimum(first + size, before[1:][row])
    hashes = run_hash(prefix_hash(words), first, last)
    keys = np.unique(row.astype(np.uint64) << _RANK | hashes >> (np.uint64(64) - _RANK))
    bounds = np.searchsorted(keys, np.arange(len(count) + 1).astype(np.uint64) << _RANK)
    return keys & ((np.uint64(1) << _RANK) - np.uint64(1)), bounds


def signatures(ranks: np.ndarray, bounds: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation signatures of the sets that have members, a row each."""
    rows = np.flatnonzero(np.diff(bounds) > 0)
    row = np.repeat(np.arange(len(rows)), np.diff(bounds)[rows])
    place = (ranks >> (_RANK - np.uint64(bins.bit_length() - 1))).astype(np.int64)
    slot = row * bins + place
    least = np.flatnonzero(np.diff(slot, prepend=-1))  # ranks ascend, so a bin's first is its least
    values = np.zeros(len(rows) * bins, np.uint64)
    full = np.zeros(len(rows) * bins, bool)
    values[slot[least]], full[slot[least]] = ranks[least], True
    values, full = values.reshape(-1, bins), full.reshape(-1, bins)
    empty_row, empty_bin = np.nonzero(~full)
    attempt = 0
    out = values.copy()
    while len(empty_row):
        step = mix(empty_bin.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt))
        donor = (step % np.uint64(bins)).astype(np.int64)
        found = full[empty_row, donor]
        out[empty_row[found], empty_bin[found]] = values[empty_row[found], donor[found]]
        empty_row, empty_bin = empty_row[~found], empty_bin[~found]
        attempt += 1
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One bucket key per row and band."""
    parts = signature.reshape(len(signature), bands, -1)
    key = np.arange(bands, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for k in range(parts.shape[2]):
        key = mix(key * np.uint64(0xFF51AFD7ED558CCD) + parts[:, :, k])
    return key


def describe(docs: DataFrame, size: int, id_column: str, text_column: str, keep: list[str] = ()) -> DataFrame:
    """Per row: ``n`` shingles, ``node`` (null for an empty set), signature bytes, bucket keys, and
    the columns to keep, which are numbers."""
    keep = list(keep)
    named = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), *keep)
    kind = named.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw, starts = text_bytes(batch.column(1))
        for lo, hi in row_slices(starts):
            ranks, bounds = shingle_sets(raw[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo], size)
            n = np.diff(bounds)
            some = np.flatnonzero(n)
            node, sketch, keys = [None] * len(n), [None] * len(n), [None] * len(n)
            if len(some):
                signature = signatures(ranks, bounds, BINS)
                sums = np.add.reduceat(mix(ranks + np.uint64(1)), bounds[some])
                names = mix(sums + n[some].astype(np.uint64)).view(np.int64).tolist()
                low = mix(signature).astype(np.uint8)
                for i, row in enumerate(some.tolist()):
                    node[row], sketch[row] = names[i], low[i].tobytes()
                for row, found in zip(some.tolist(), band_keys(signature, BANDS).view(np.int64).tolist()):
                    keys[row] = found
            columns = [batch.column(0)[lo:hi], pa.array(n, pa.int64()), pa.array(node, pa.int64())]
            columns += [pa.array(sketch, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            columns += [batch.column(k)[lo:hi] for k in range(2, 2 + len(keep))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "node", "sketch", "keys", *keep])

    schema = f"doc_id {kind}, n long, node long, sketch binary, keys array<long>"
    return map_arrow(named, ["doc_id", "text", *keep], work, ", ".join([schema, *(f"{c} long" for c in keep)]))


def _full_sets(docs: DataFrame, nodes: DataFrame, size: int, id_column: str, text_column: str) -> DataFrame:
    """``node`` and its shingles, from one text each; ``nodes`` has ``node`` and its lowest id."""
    ids = nodes.select(F.col("low").alias("wanted")).distinct()
    named = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    texts = named.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted"))).select("text")

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw, starts = text_bytes(batch.column(0))
        for lo, hi in row_slices(starts):
            ranks, bounds = shingle_sets(raw[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo], size)
            some = np.flatnonzero(np.diff(bounds))
            if len(some):
                sums = np.add.reduceat(mix(ranks + np.uint64(1)), bounds[some])
                names = mix(sums + np.diff(bounds)[some].astype(np.uint64)).view(np.int64)
                sets = [ranks[bounds[r] : bounds[r + 1]].tobytes() for r in some]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sets, pa.binary())], ["node", "shingles"])

    found = map_arrow(texts, ["text"], work, "node long, shingles binary")
    return found.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _agreeing(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Candidate pairs whose sizes and signatures allow the similarity."""
    a = sketches.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = sketches.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    joined = pairs.join(a, "a").join(b, "b")
    joined = joined.filter(100 * F.least("na", "nb") >= SIMILAR * F.greatest("na", "nb"))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BINS) for k in (2, 3))
        near = (left == right).sum(1) >= AGREE
        near |= np.minimum(batch.column(4).to_numpy(), batch.column(5).to_numpy()) < WHOLE
        yield batch.select([0, 1]).filter(pa.array(near))

    return map_arrow(joined, ["a", "b", "sa", "sb", "na", "nb"], work, "a long, b long")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        near = []
        for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            near.append(100 * both >= SIMILAR * (len(x) + len(y) - both))
        yield batch.select([0, 1]).filter(pa.array(near))

    return map_arrow(pairs.join(a, "a").join(b, "b"), ["a", "b", "sa", "sb"], work, "a long, b long")


def _prefix_pairs(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``node``, ``centre`` of different components ``c`` of the rest, among them all that reach
    the similarity.

    In one order of all shingles, the first one that two sets share leaves each of them at least as
    many places as they must share. Shingles of one component pair nobody and come first; then the
    rarest, so a passage that many texts hold comes last."""

    def spread(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64) // 8
        shingles = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64)
        columns = [np.repeat(batch.column(k).to_numpy(), n) for k in (0, 1)]
        columns += [np.repeat(n, n), shingles]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["node", "c", "n", "shingle"])

    whole = stored(sets.join(rest, "node").select("node", "c", "shingles"), "rest-sets")
    each = map_arrow(whole, ["node", "c", "shingles"], spread, "node long, c long, n long, shingle long")
    counts = each.groupBy("shingle").agg(F.count("*").alias("f"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    counts = stored(counts.filter("lo < hi").select("shingle", "f"), "shingle-counts")
    held = each.join(counts, "shingle").groupBy("node", "c", "n").agg(F.array_sort(F.collect_list(F.struct("f", "shingle"))).alias("held"))
    # Places that leave enough for a set no longer than this one.
    room = F.expr(f"CAST(greatest(size(held) - ceil({SIMILAR} * n / 100) + 1, 0) AS int)")
    before = F.col("n") - F.size("held")
    first = held.select("node", "c", "n", before.alias("skipped"), F.posexplode(F.slice("held", F.lit(1), room)).alias("k", "s"))
    first = stored(first.select("node", "c", "n", (F.col("n") - F.col("skipped") - F.col("k")).alias("left"), F.col("s.shingle").alias("shingle")), "prefixes")
    # The largest component of a shingle meets the others alone.
    parts = first.groupBy("shingle", "c").agg(F.count("*").alias("m")).groupBy("shingle")
    parts = parts.agg(F.max_by("c", F.struct("m", "c")).alias("big"), F.count("*").alias("parts")).filter("parts > 1")
    first = first.join(stored(parts.select("shingle", "big"), "shingle-parts"), "shingle")
    first = stored(first.withColumn("big", F.col("c") == F.col("big")), "shared-prefixes")
    longer = first.select("shingle", "big", *(F.col(k).alias(f"{k}_1") for k in ("node", "c", "n", "left")))
    shorter = first.filter(f"{100 + SIMILAR} * left >= {2 * SIMILAR} * n")
    shorter = shorter.select("shingle", F.col("big").alias("big_2"), *(F.col(k).alias(f"{k}_2") for k in ("node", "c", "n", "left")))
    fits = F.expr(
        "c_1 <> c_2 AND (n_1 > n_2 OR n_1 = n_2 AND node_1 < node_2)"
        f" AND {100 + SIMILAR} * least(left_1, left_2) >= {SIMILAR} * (n_1 + n_2) AND 100 * n_2 >= {SIMILAR} * n_1"
    )
    met = longer.filter("NOT big").join(shorter, "shingle").filter(fits)
    met = met.unionByName(longer.filter("big").join(shorter.filter("NOT big_2"), "shingle").filter(fits))
    return met.select(F.col("node_1").alias("node"), F.col("node_2").alias("centre"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its least node, of all nodes that have links. Each round takes the
    least label among neighbours and then the label of that label."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = stored(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))), "links")
    labels = both.groupBy("node").agg(F.min("other").alias("o")).select("node", F.least("node", "o").alias("component"))
    labels = stored(labels, "labels")
    while True:
        there = labels.select(F.col("node").alias("other"), F.col("component").alias("c"))
        near = stored(both.join(there, "other").groupBy("node").agg(F.min("c").alias("c")), "near-labels")
        least = labels.join(near, "node").select("node", "component", F.least("component", "c").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        moved = least.join(jump, "next").select("node", F.least("next", "far").alias("component"), F.col("component").alias("was"))
        moved = stored(moved, "labels")
        labels = moved.select("node", "component")
        if not moved.filter("component <> was").limit(1).count():
            return labels


def near_links(docs: DataFrame, described: DataFrame, size: int, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """Components of the nodes that have links, and all links found."""
    bucketed = described.filter("node IS NOT NULL").select("node", F.explode("keys").alias("key"))
    members = stored(bucketed.groupBy("key", "node").agg(F.lit(1).alias("one")).select("key", "node"), "members")
    sizes = stored(members.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"), "buckets")
    members = stored(members.join(sizes, "key"), "shared-buckets")
    shared = stored(members.groupBy("node").agg(F.sum("m").alias("shared")), "shared")
    ranked = members.join(shared, "node")
    order = F.shiftleft("shared", 20) + F.pmod(F.xxhash64("node"), F.lit(1 << 20))
    centre = stored(ranked.groupBy("key").agg(F.max_by("node", order).alias("centre")), "centres")
    per_node = described.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("low"), F.max("n").alias("n"))
    per_node = per_node.join(shared.select("node"), "node", "left_semi")
    nodes = stored(per_node, "nodes")
    rep = described.select("doc_id", "node", "sketch").join(
        nodes.select("node", "low", "n"), "node"
    ).filter(F.col("doc_id").eqNullSafe(F.col("low")))
    sketches = stored(rep.dropDuplicates(["node"]).select("node", "n", "sketch"), "sketches")
    sets = stored(_full_sets(docs, nodes, size, id_column, text_column), "shingle-sets")

    def linked(pairs: DataFrame) -> DataFrame:
        ends = (F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
        once = pairs.filter("node <> centre").select(*ends).groupBy("a", "b").agg(F.lit(1).alias("one"))
        return _linked(stored(_agreeing(once.select("a", "b"), sketches), "near-pairs"), sets)

    links = stored(linked(members.join(centre, "key").select("node", "centre")), "verified-links")
    labels = settled(docs.sparkSession, lambda of=links: components(of), "components")

    def open_members(most: int) -> DataFrame:
        """Members, and their components, of the buckets with more members that hold several."""
        placed = members.join(labels, "node", "left").select("key", "node", "m", F.coalesce("component", "node").alias("c"))
        placed = stored(placed.filter(F.col("m") > most), "placed")
        split = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("key")
        return placed.join(stored(split, "open-buckets"), "key")

    # Buckets that hold more than one component draw centres of their own, so a member meets others
    # in each of its buckets.
    placed = stored(open_members(2), "open-members")
    draw = F.pmod(F.xxhash64("node", "key"), F.lit(1 << 30)) * F.col("m") < DRAWN << 30
    drawn = stored(placed.filter(draw).select("key", F.col("node").alias("centre"), F.col("c").alias("centre_c")), "drawn")
    found = stored(linked(placed.join(drawn, "key").filter("c <> centre_c").select("node", "centre")), "verified-links")
    if found.limit(1).count():
        links = stored(links.unionByName(found), "verified-links")
        labels = settled(docs.sparkSession, lambda of=links: components(of), "components")
    # Buckets of up to DRAWN members have been searched whole; what others still hold is searched here.
    rest = stored(open_members(DRAWN).groupBy("node").agg(F.min("c").alias("c")), "rest")
    found = stored(linked(_prefix_pairs(rest, sets)), "verified-links")
    if found.limit(1).count():
        links = stored(links.unionByName(found), "verified-links")
        labels = settled(docs.sparkSession, lambda of=links: components(of), "components")
    return labels, links


def near_duplicates(docs: DataFrame, size: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each row's ``n_shingles``, ``component_id`` (least id reachable) and whether it is that one."""
    described = stored(describe(docs, size, id_column, text_column), "signatures")
    labels, _ = near_links(docs, described, size, id_column, text_column)
    lows = described.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("low"))
    named = lows.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stored(named, "named")
    least = stored(named.groupBy("component").agg(F.min("low").alias("component_id")), "least-ids")
    per_node = stored(named.join(least, "component").select("node", "component_id"), "component-ids")
    rows = described.select("doc_id", F.col("n").alias("n_shingles"), "node")
    joined = rows.join(per_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def keep_one(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row of each group of near duplicates, all columns: that with the least id, and one of
    several rows with that id and text. Texts without a word are no duplicates of others."""
    text = F.coalesce("text", F.lit(""))
    marks = {"mark_1": F.xxhash64(text), "mark_2": F.xxhash64(F.lit(1), text)}
    described = stored(describe(docs.withColumns(marks), size, "doc_id", "text", list(marks)), "signatures")
    labels, _ = near_links(docs, described, size, "doc_id", "text")
    rows = described.select("doc_id", *marks, "node").join(labels, "node", "left")
    alone = F.col("node").isNull()
    group = [F.coalesce("component", "node").alias("g"), *(F.when(alone, F.col(c)).alias(f"g_{c}") for c in ("doc_id", *marks))]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *marks))
    kept = rows.groupBy(*group).agg(first.alias("k"))
    kept = stored(kept.select(F.col("k.doc_id").alias("kept_id"), F.col("k.mark_1").alias("k1"), F.col("k.mark_2").alias("k2")), "kept")
    packed = docs.select(F.struct(*docs.columns).alias("whole_row"), F.col("doc_id").alias("kept_id"), marks["mark_1"].alias("k1"), marks["mark_2"].alias("k2"))
    same = F.col("p.kept_id").eqNullSafe(F.col("q.kept_id")) & (F.col("p.k1") == F.col("q.k1")) & (F.col("p.k2") == F.col("q.k2"))
    found = packed.alias("p").join(kept.alias("q"), same, "left_semi").dropDuplicates(["kept_id", "k1", "k2"])
    return found.select(*(F.col(f"whole_row.{c}").alias(c) for c in docs.columns))


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return settled(spark, lambda: near_duplicates(docs), "near-duplicates")
