"""Compression of vectors to short codes, by dual-tree Lloyd iterations over integers.

A component x becomes floor(4096 x). A vector is cut into equal parts, and each part position has a
codebook, fitted by Lloyd's method and then used to encode every vector.

Each block of vectors (some thousands, in one task) gets a balanced tree per part position: a node
has the box around its points, their number and their sum. The trees are built once and stored; a
round reads them and takes the codebooks' entries through a tree too. From the roots down, pairs
of a node and a group of entries are dropped where another group is nearer to the whole box, by
bounds on box to box distances; then single entries are dropped where the entry nearest to the
box's middle is nearer than they are to all of the box (equally near counts if it has the lower
index). A node with one entry left is assigned whole, by its cached sum; in leaves with several
left, points are compared one by one. All of it is whole numbers, so the result is that of
plain comparison, whatever the blocks. The driver sees the sums per entry, whose number the codebooks set.

Defined results: rows whose vector is null or empty, or has a null or non-finite component, are
left out. The first entries come from the least ids, nulls last, equal ids by vector; there are
fewer entries if there are fewer rows. Rows with equal or null ids are coded one by one. Vectors
of different lengths, of a length that the parts do not divide, or with components so
large that a distance could exceed 64 bits (16,384 for 64 components) are refused with an
error. An empty table gives no rows; other columns are ignored, but for a label if named.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, stored

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
# Vectors of a block, and points of a leaf (at most; at least half).
BLOCK, LEAF = 4096, 32
# Bytes of a row group of stored blocks, which a reader holds at once.
GROUP_BYTES = 16 * 1024 * 1024

Codebooks = list[np.ndarray]


def _whole(vector: Column) -> Column:
    """Whether no component is missing."""
    real = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(real, F.lit(False))


def _integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


# --- trees ----------------------------------------------------------------------


class Tree:
    """A balanced tree over points: levels of nodes that halve those above, down to ``leaf`` points.
    ``order`` puts the points so that each node's are neighbours from ``begin`` to ``end``."""

    def __init__(self, points: np.ndarray, leaf: int) -> None:
        n = len(points)
        self.order = np.arange(n)
        self.levels: list[tuple[np.ndarray, ...]] = []
        edges = np.array([0, n])
        while True:
            placed = points[self.order]
            low, high = np.minimum.reduceat(placed, edges[:-1]), np.maximum.reduceat(placed, edges[:-1])
            sums = np.add.reduceat(placed, edges[:-1])
            self.levels.append((edges[:-1], edges[1:], low, high, sums))
            sizes = np.diff(edges)
            if sizes.max() <= leaf or sizes.min() < 2:
                break
            # Halve every node at the middle of its widest component.
            node = np.repeat(np.arange(len(sizes)), sizes)
            widest = np.argmax(high - low, axis=1)
            self.order = self.order[np.lexsort((placed[np.arange(n), widest[node]], node))]
            edges = np.sort(np.concatenate([edges, (edges[:-1] + edges[1:]) // 2]))
        self.points = points[self.order]

    def pack(self) -> bytes:
        """Points, order and levels as bytes: points as 32-bit numbers, the rest as 64-bit ones."""
        head = np.array([*self.points.shape, len(self.levels)], np.int64)
        flat = [a.astype(np.int64).tobytes() for level in self.levels for a in level]
        return b"".join([head.tobytes(), self.order.astype(np.int64).tobytes(), self.points.astype(np.int32).tobytes(), *flat])

    @classmethod
    def unpack(cls, data: bytes) -> Tree:
        tree, at = cls.__new__(cls), 24
        n, d, depth = np.frombuffer(data, np.int64, 3).tolist()
        tree.order = np.frombuffer(data, np.int64, n, at)
        at += 8 * n
        tree.points = np.frombuffer(data, np.int32, n * d, at).reshape(n, d).astype(np.int64)
        at += 4 * n * d
        tree.levels = []
        for k in range(depth):
            nodes, level = 1 << k, []
            for width in (0, 0, d, d, d):
                size = nodes * max(width, 1)
                one = np.frombuffer(data, np.int64, size, at)
                level.append(one.reshape(nodes, width) if width else one)
                at += 8 * size
            tree.levels.append(tuple(level))
        return tree


def _pruned(low: np.ndarray, high: np.ndarray, book: np.ndarray, groups: Tree, alive: np.ndarray) -> np.ndarray:
    """The entries that can be nearest to a point of each box, of those that were left above."""
    # By groups of entries: one is dropped whose least distance exceeds another's greatest.
    for begin, end, glow, ghigh, _ in groups.levels:
        some = np.add.reduceat(alive[:, groups.order], begin, axis=1) > 0
        gap = np.maximum(np.maximum(glow[None] - high[:, None], low[:, None] - ghigh[None]), 0)
        reach = np.maximum(ghigh[None] - low[:, None], high[:, None] - glow[None])
        nearest, farthest = (gap * gap).sum(axis=2), (reach * reach).sum(axis=2)
        bound = np.where(some, farthest, np.iinfo(np.int64).max).min(axis=1)
        keep = np.repeat(some & (nearest <= bound[:, None]), end - begin, axis=1)
        alive = alive & keep[:, np.argsort(groups.order)]
    # By single entries: distance to the one nearest to the middle minus distance to each other
    # one is linear in the point, so its greatest value is at a corner of the box.
    middle = (low + high)[:, None] - 2 * book[None]
    apart = np.where(alive, (middle * middle).sum(axis=2), np.iinfo(np.int64).max)
    best = apart.argmin(axis=1)
    chosen = book[best][:, None]
    slope = 2 * (book[None] - chosen)
    corner = np.where(slope > 0, high[:, None], low[:, None])
    worst = (slope * corner + chosen * chosen - book[None] * book[None]).sum(axis=2)
    index = np.arange(len(book))[None]
    beaten = (worst < 0) | ((worst == 0) & (best[:, None] < index))
    beaten[np.arange(len(best)), best] = False
    return alive & ~beaten


def _distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    away = points[:, None] - book[None]
    return (away * away).sum(axis=2)


def assign(tree: Tree, book: np.ndarray, codes: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Number and sum of the points of each entry and, if asked for, each point's entry."""
    counts, sums = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
    placed = np.zeros(len(tree.points), np.int64) if codes else None
    groups = Tree(book, 1)
    nodes, alive = np.zeros(1, np.int64), np.ones((1, len(book)), bool)
    for depth, (begin, end, low, high, total) in enumerate(tree.levels):
        if not len(nodes):
            break
        alive = _pruned(low[nodes], high[nodes], book, groups, alive)
        sure = alive.sum(axis=1) == 1
        entry = alive.argmax(axis=1)
        done, to = nodes[sure], entry[sure]
        np.add.at(counts, to, end[done] - begin[done])
        np.add.at(sums, to, total[done])
        if placed is not None:
            for node, e in zip(done.tolist(), to.tolist(), strict=True):
                placed[begin[node] : end[node]] = e
        nodes, alive = nodes[~sure], alive[~sure]
        if depth + 1 < len(tree.levels):
            nodes, alive = np.stack([2 * nodes, 2 * nodes + 1], axis=1).reshape(-1), np.repeat(alive, 2, axis=0)
        elif len(nodes):
            sizes = end[nodes] - begin[nodes]
            owner = np.repeat(np.arange(len(nodes)), sizes)
            at = np.repeat(begin[nodes] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            apart = np.where(alive[owner], _distances(tree.points[at], book), np.iinfo(np.int64).max)
            nearest = apart.argmin(axis=1)
            np.add.at(counts, nearest, 1)
            np.add.at(sums, nearest, tree.points[at])
            if placed is not None:
                placed[at] = nearest
    return counts, sums, placed


# --- blocks ---------------------------------------------------------------------


def _blocks(kept: DataFrame, parts: int, size: int) -> DataFrame:
    """Rows of ``doc`` (id and label lists) and ``trees``, one for each block of vectors."""
    prepare(kept.sparkSession)
    kinds = kept.schema

    def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        vectors = table.column("v").combine_chunks()
        points = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), size)
        trees = [Tree(part, LEAF).pack() for part in np.split(points, parts, axis=1)]
        one = [0, len(vectors)]
        lists = [pa.ListArray.from_arrays(pa.array(one, pa.int32()), table.column(c).combine_chunks()) for c in ("id", "label")]
        return pa.RecordBatch.from_arrays([*lists, pa.array([trees], pa.list_(pa.binary()))], names=["ids", "labels", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            while batch.num_rows:
                take = min(batch.num_rows, BLOCK - count)
                held.append(batch.slice(0, take))
                count, batch = count + take, batch.slice(take)
                if count == BLOCK:
                    yield block(held)
                    held, count = [], 0
        if count:
            yield block(held)

    schema = f"ids array<{kinds['id'].dataType.simpleString()}>, labels array<{kinds['label'].dataType.simpleString()}>, trees array<binary>"
    return kept.mapInArrow(run, schema)


def _sums(blocks: DataFrame, books: Codebooks) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Number and componentwise sum of the parts of each entry that has any, by position and index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for trees in batch.column(0).to_pylist():
                for p, data in enumerate(trees):
                    n, s, _ = assign(Tree.unpack(data), books[p], codes=False)
                    counts[p] += n
                    sums[p] += s
        rows = [(p, e, int(n), c, int(s)) for p, b in enumerate(sums) for e, n in enumerate(counts[p]) if n for c, s in enumerate(b[e])]
        names = ["part", "entry", "n", "place", "total"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(5)], names=names)

    partial = blocks.select("trees").mapInArrow(run, "part long, entry long, n long, place long, total long")
    total = partial.groupBy("part", "entry", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    made: dict[tuple[int, int], tuple[int, list[int]]] = {}
    # As many rows as the codebooks have numbers.
    for r in total.orderBy("part", "entry", "place").collect():
        made.setdefault((r.part, r.entry), (r.n, []))[1].append(int(r.total))
    return made


def _moved(books: Codebooks, made: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
    """Entries at the mean of their parts, floors going down; those without parts stay."""
    books = [b.copy() for b in books]
    for (p, e), (n, total) in made.items():
        books[p][e] = [s // n for s in total]
    return books


def _coded(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """``id``, ``label``, ``code`` (hex digits) and ``error`` of each vector."""
    kinds = {c: blocks.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels")}

    def one(ids: pa.Array, labels: pa.Array, trees: list[bytes]) -> pa.RecordBatch:
        codes, error = np.zeros((len(ids), len(books)), np.uint8), np.zeros(len(ids), np.int64)
        for p, data in enumerate(trees):
            tree = Tree.unpack(data)
            placed = assign(tree, books[p], codes=True)[2]
            away = tree.points - books[p][placed]
            codes[tree.order, p] = placed
            error[tree.order] += (away * away).sum(axis=1)
        texts = [bytes(row).hex() for row in codes]
        return pa.RecordBatch.from_arrays([ids, labels, pa.array(texts, pa.string()), pa.array(error)], names=["id", "label", "code", "error"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, labels = (batch.column(c).slice(k, 1).flatten() for c in (0, 1))
                yield one(ids, labels, batch.column(2)[k].as_py())

    return blocks.mapInArrow(run, f"id {kinds['ids']}, label {kinds['labels']}, code string, error long")


def encode(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str | None = None,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """Fits the codebooks and encodes every vector with them: ``id``, ``label`` (null if not named),
    ``code`` (two hex digits a part) and ``error``, the squared distance that is left."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte for each part: 1 to 256 entries")
    vector = F.col(vector_column)
    label = F.col(label_column) if label_column else F.lit(None).cast("int")
    kept = vectors.filter(_whole(vector)).select(F.col(id_column).alias("id"), label.alias("label"), _integers(vector).alias("v"))
    first = [r.v for r in kept.orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()]
    size = len(first[0]) if first else parts
    if size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    # Sixteen times the squares of a vector's largest components stay below 2^63.
    most = int((2**58 / max(size, 1)) ** 0.5)
    fits = (F.size("v") == size) & F.forall("v", lambda x: F.abs(x) <= most)
    refused = F.raise_error(F.lit(f"a vector has other than {size} components, or one above {most / SCALE:g}")).cast("boolean")
    blocks = stored(_blocks(kept.filter(F.when(fits, True).otherwise(refused)), parts, size), "vector-blocks", GROUP_BYTES)
    books = [np.array(b, np.int64) for b in zip(*(np.split(np.array(v, np.int64), parts) for v in first), strict=True)]
    for _ in range(rounds if first else 0):
        books = _moved(books, _sums(blocks, books))
    return _coded(blocks, books), books


def digest(books: Codebooks) -> str:
    """Checksum of all entries' components, by part, entry and place."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.reshape(-1)).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = encode(spark.read.parquet(f"{folder}/embeddings.parquet"), label_column="label")
    coded = stored(coded, "vector-codes")
    # Null-safe, so that the sums have an exchange of their own and a hot label can be split.
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def _op12_sql() -> str:
    """The rounds written out: each assigns all parts by ranking distances, then moves the entries."""
    steps = [
        """kept AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id, embedding) AS r FROM embeddings
        WHERE len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)""",
        f"""c AS (SELECT r, (i - 1) // (len(embedding) // {PARTS}) AS p, (i - 1) % (len(embedding) // {PARTS}) AS j,
        CAST(floor(CAST(embedding[i] AS DOUBLE) * {SCALE}) AS BIGINT) AS x
        FROM (SELECT r, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept))""",
        f"b0 AS (SELECT p, r - 1 AS e, j, x FROM c WHERE r <= {ENTRIES})",
    ]
    for k in range(ROUNDS + 1):
        steps.append(
            f"""a{k} AS (SELECT r, p, min(struct_pack(d := d, e := e)) AS best FROM (
            SELECT c.r, c.p, b{k}.e, sum((c.x - b{k}.x) * (c.x - b{k}.x)) AS d FROM c JOIN b{k} ON c.p = b{k}.p AND c.j = b{k}.j
            GROUP BY c.r, c.p, b{k}.e) GROUP BY r, p)"""
        )
        if k < ROUNDS:
            steps.append(
                f"""m{k} AS (SELECT p, e, j, (s - ((s % n) + n) % n) // n AS x FROM (
                SELECT c.p, a{k}.best.e AS e, c.j, sum(c.x) AS s, count(*) AS n FROM c JOIN a{k} ON c.r = a{k}.r AND c.p = a{k}.p
                GROUP BY c.p, a{k}.best.e, c.j))"""
            )
            steps.append(
                f"""b{k + 1} AS (SELECT b{k}.p, b{k}.e, b{k}.j, coalesce(m{k}.x, b{k}.x) AS x
                FROM b{k} LEFT JOIN m{k} ON b{k}.p = m{k}.p AND b{k}.e = m{k}.e AND b{k}.j = m{k}.j)"""
            )
    last = f"b{ROUNDS}"
    return f"""WITH {", ".join(steps)},
    v AS (SELECT r, string_agg(lpad(to_hex(best.e), 2, '0'), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
        FROM a{ROUNDS} GROUP BY r)
    SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) FROM {last}) AS codebooks_sha256
    FROM kept JOIN v ON kept.r = v.r"""


OP12_SQL = _op12_sql()
