"""Mixing, vector codes and periodic runs against plain versions, on awkward rows and the smallest tables."""

from __future__ import annotations

import collections
import datetime
import hashlib
import math
import os
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import mixing, periodic_runs, registered, vector_codes

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, source string, size int, words string, target long, rows int, runs string, rate double"
VECTORS = "vec_id long, embedding array<float>, label int, code string, id int, error int, trees string"


# --- mixing ---------------------------------------------------------------------


def plain_targets(words: dict, weights=mixing.WEIGHTS, total=mixing.TOTAL, most=mixing.MOST) -> dict:
    order = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full: set = set()
    while True:
        left = total * sum(words.values()) - most * sum(words[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        aim = {s: most * words[s] if s in full else left * weight[s] / share for s in order}
        above = {s for s in order if s not in full and aim[s] >= most * words[s]}
        if not above:
            return aim
        full |= above


def plain_copies(rows: list[tuple], most=mixing.MOST) -> collections.Counter:
    """Copies of each (source, size), by bisection over the multiplier."""
    words = collections.Counter()
    cells: dict = collections.defaultdict(collections.Counter)
    for _, source, size in rows:
        words[source] += size
        cells[source][size] += 1
    aims, copies = plain_targets(words), collections.Counter()
    for source, of in cells.items():
        def rate(a, size):
            return min(most, math.exp(min(a * size, 1)))

        low, high = -1e3, 1e3
        for _ in range(200):
            a = (low + high) / 2
            if sum(n * s * rate(a, s) for s, n in of.items()) > aims[source]:
                high = a
            else:
                low = a
        given, taken = 0.0, 0
        for size in sorted(of, reverse=True):
            given += of[size] * size * (most if aims[source] >= most * words[source] else rate(low, size))
            n = min(max(math.floor((given - taken) / size + 0.5), 0), most * of[size]) if size else of[size]
            taken += n * size
            copies[source, size] = n
    return copies


def check_mix(rows: list) -> None:
    """Rows of doc_id, source, size, source_size, target and copies."""
    words = collections.Counter()
    for r in rows:
        words[r.source] += r.size
    aims = plain_targets(words)
    got, count, each = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for r in rows:
        assert r.source_size == words[r.source] and r.target == pytest.approx(aims[r.source], rel=1e-12)
        assert 0 <= r.copies <= 2
        got[r.source, r.size] += r.copies
        count[r.source, r.size] += 1
        each[r.source, r.size].add(r.copies)
    assert got == plain_copies([(r.doc_id, r.source, r.size) for r in rows])
    assert all(max(c) - min(c) <= 1 for c in each.values())
    for source, aim in aims.items():
        least, most = (f(size for s, size in got if s == source) for f in (min, max))
        # Whole copies of a document that is most of its source cannot come nearer than half of it.
        assert most > words[source] / 2 or abs(sum(n * size for (s, size), n in got.items() if s == source) - aim) <= max(1, 0.02 * aim, least)


def test_mixing_like_the_plain_version(spark):
    rows = mixing.op11_mixing(spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert sorted((r.doc_id, r.source, r.size) for r in rows) == sorted(
        (d.doc_id, d.source, len(re.findall(r"[^\x20\x09-\x0D]+", d.text or ""))) for d in docs
    )
    check_mix(rows)
    assert all(r.taken == r.copies * r.size for r in rows)
    # Another run, over other partitions, takes the same documents.
    again = mixing.mix(spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(7))
    assert sorted((r.doc_id, r.copies) for r in again.collect()) == sorted((r.doc_id, r.copies) for r in rows)


def awkward(spark):
    draw = random.Random(4)
    rows = [(None, None, None), (None, "", "é"), (5, " \t\n", ""), (6, "one", "é"), (6, "one", "é"), (6, "one", "é"), (6, "another two", "é")]
    rows += [(100 + i, " ".join("w" * draw.choice([1, 2, 9, 300])), draw.choice([None, "", "a", "Z", "é", "\U0001f600"])) for i in range(400)]
    rows += [(9000 + i, "same text of five words", "hot") for i in range(500)] + [(7, "hot id", "hot")] * 300
    rows += [(9999, "long " * 60_000, "a")]
    return spark.createDataFrame([(i, t, s, 1, "w", 2, 3, "r", 0.5) for i, t, s in rows], SCHEMA).repartition(5)


def test_mixing_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    check_mix(rows)
    unfolded = mixing.repeated(docs.filter("doc_id >= 100"), mixing.mix(docs.filter("doc_id >= 100")))
    taken = collections.Counter(r.doc_id for r in unfolded.collect())
    assert unfolded.columns == docs.columns and set(taken.values()) <= {1, 2}


def test_rows_of_one_id_are_unfolded_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(mixing, "UNFOLD", 7)
    docs = awkward(spark).filter("source = 'hot'")
    rows = mixing.mix(docs.union(docs.withColumn("source", F.lit("rest")))).collect()
    assert len(rows) == 2 * docs.count()
    check_mix(rows)


def test_targets_stop_at_twice_a_source(spark):
    cells = spark.createDataFrame([("a", 10, 1), ("b", 1, 100), (None, 1000, 1), ("d", 0, 5)], "source string, size long, rows long")
    got = {r.source: r.target for r in mixing.targets(cells).collect()}
    assert got == {"a": 20.0, "b": 200.0, "d": 0.0, None: pytest.approx(1.5 * 1110 - 220)}


def test_a_mix_of_more_than_all_copies_is_refused(spark):
    with pytest.raises(ValueError):
        mixing.mix(awkward(spark), total=2.5)


# --- vector codes ---------------------------------------------------------------


def plain_codes(rows: list[tuple], parts=8, entries=16, rounds=6):
    """Ids, codes and errors with the books, by comparing every part with every entry."""
    kept = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [np.array([math.floor(float(np.float32(x)) * 4096) for x in v], np.int64).reshape(parts, -1) for _, v in kept]
    books = [[w[p].tolist() for w in whole[:entries]] for p in range(parts)]

    def nearest(p, part):
        away = [sum((int(a) - b) ** 2 for a, b in zip(part, e, strict=True)) for e in books[p]]
        return min(range(len(away)), key=lambda e: (away[e], e)), min(away)

    for _ in range(rounds):
        for p in range(parts):
            members = collections.defaultdict(list)
            for w in whole:
                members[nearest(p, w[p])[0]].append(w[p].tolist())
            for e, own in members.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    coded = []
    for (i, _), w in zip(kept, whole, strict=True):
        each = [nearest(p, w[p]) for p in range(parts)]
        coded.append((i, "".join(f"{e:02x}" for e, _ in each), sum(d for _, d in each)))
    flat = ",".join(str(x) for book in books for e in book for x in e)
    return coded, hashlib.sha256(flat.encode()).hexdigest()


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_vector_codes_like_duckdb(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    names = "vec_id, code, error, label_error, codebooks_sha256"
    want = duck.execute(f"SELECT {names} FROM ({registered.ORACLES['op12_vector_codes']})").fetchall()
    got = vector_codes.op12_vector_codes(spark, FOLDER)
    assert order(tuple(r) for r in got.select(*names.split(", ")).collect()) == order(want)


def test_vector_codes_of_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 50)
    draw = random.Random(8)
    vectors = [[draw.choice([-1.0, -0.25, 0.0, 0.25, 1.0]) for _ in range(16)] for _ in range(40)]
    rows = [(draw.choice([None, *range(60)]), draw.choice(vectors), draw.choice([None, 1, 2])) for _ in range(300)]
    rows += [(1000 + i, [draw.gauss(0, 1) for _ in range(16)], 3) for i in range(200)]
    gone = [None, [], [None] * 16, [float("nan")] + [0.0] * 15, [float("inf")] + [0.0] * 15, [0.0] * 15 + [None]]
    rows += [(-5 - i, v, None) for i, v in enumerate(gone)]
    table = spark.createDataFrame([(*r, "c", 1, 2, "t") for r in rows], VECTORS).repartition(3)
    coded, books = vector_codes.encode(table, label_column="label")
    want, checksum = plain_codes([(i, v) for i, v, _ in rows])
    assert vector_codes.digest(books) == checksum
    assert order((r.id, r.code, r.error) for r in coded.collect()) == order(want)


def test_fewer_vectors_than_entries_and_none(spark):
    few, _ = vector_codes.encode(spark.createDataFrame([(3, [1.0] * 8, 1), (2, [0.5] * 8, 1)], "vec_id long, embedding array<float>, label int"))
    assert order((r.id, r.code, r.error) for r in few.collect()) == [(2, "00" * 8, 0), (3, "01" * 8, 0)]
    none, books = vector_codes.encode(spark.createDataFrame([], VECTORS), label_column="label")
    assert none.collect() == [] and books == [] and vector_codes.digest(books) == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("vector", [[0.0] * 8, [0.0] * 15 + [70_000.0]])
def test_vectors_that_do_not_fit_are_refused(spark, vector):
    table = spark.createDataFrame([(1, [0.0] * 16, 1), (2, vector, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="a vector has other than 16 components"):
        vector_codes.encode(table)[0].collect()
    with pytest.raises(ValueError):
        vector_codes.encode(spark.createDataFrame([(1, [0.0] * 9, 1)], table.schema))


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_trees_assign_like_comparing(data):
    seed, n, d, k = (data.draw(st.integers(a, b)) for a, b in ((0, 10**6), (1, 300), (1, 8), (1, 16)))
    draw = np.random.default_rng(seed)
    span = data.draw(st.sampled_from([1, 3, 40, 1 << 20]))
    points, book = draw.integers(-span, span + 1, (n, d)), draw.integers(-span, span + 1, (k, d))
    if data.draw(st.booleans()):
        book = points[draw.integers(0, n, k)]
    tree = vector_codes.Tree.unpack(vector_codes.Tree(points, data.draw(st.sampled_from([1, 4, 32]))).pack())
    counts, sums, placed = vector_codes.assign(tree, book, codes=True)
    want = ((points[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
    got = np.empty(n, np.int64)
    got[tree.order] = placed
    assert (got == want).all() and (counts == np.bincount(want, minlength=k)).all()
    assert all((sums[e] == points[want == e].sum(axis=0)).all() for e in range(k))


def test_whole_nodes_are_assigned_by_their_sums(monkeypatch):
    """Of points in clusters far apart, none is compared alone."""
    draw = np.random.default_rng(0)
    book = draw.integers(-(10**6), 10**6, (16, 8))
    points = book[draw.integers(0, 16, 20_000)] + draw.integers(-5, 6, (20_000, 8))
    compared = []
    monkeypatch.setattr(vector_codes, "_distances", lambda p, b: compared.append(len(p)) or ((p[:, None] - b[None]) ** 2).sum(axis=2))
    counts, _, _ = vector_codes.assign(vector_codes.Tree(points, 32), book, codes=False)
    assert counts.sum() == 20_000 and sum(compared) < 2_000


# --- periodic runs --------------------------------------------------------------


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """Start, end and smallest period of all maximal stretches of three periods, by comparing all."""
    n, best = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= 3 * q:
                best.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((b, e, q) for (b, e), q in best.items())


def plain_row(doc_id, text) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = sorted((b, e - b, q) for b, e, q in plain_runs(words) if e - b >= 24)
    found.sort(key=lambda r: (r[0], r[2]))
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for b, length, q in found for i in range(b + q, b + length)}
    lines = "".join(f"{b},{length},{q}\n" for b, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)]
    return (doc_id, len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2], *sha)


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def check_runs(spark, docs, folder: str) -> int:
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    got = [tuple(r) for r in periodic_runs.op13_periodic_runs(spark, folder).select(*COLUMNS).collect()]
    assert order(got) == order(plain_row(r.doc_id, r.text) for r in docs.collect())
    return sum(r[1] > 0 for r in got)


def test_periodic_runs_of_the_table(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("n_chars < 20000")
    assert check_runs(spark, docs, str(tmp_path)) > 5


def test_periodic_runs_of_awkward_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(periodic_runs, "PIECE", 64)
    draw = random.Random(3)
    texts = [None, "", " ", "x", "a " * 23, "a " * 24, "a b " * 40, "a\x0bb\x0cc\x1fd " * 30, "é日 " * 30 + "ß " * 30, "w" * 3000]
    unit = [f"u{i}" for i in range(40)]
    texts += [" ".join(unit * 3), " ".join(unit * 3 + unit[:7] + ["end"]), " ".join(["b"] + (unit[:20] + unit[:20] + ["c"]) * 5)]
    texts += [" ".join(draw.choice("ab") for _ in range(draw.randrange(300))) for _ in range(150)]
    texts += [" ".join([draw.choice("abc") for _ in range(draw.randrange(1, 50))] * draw.randrange(1, 6)) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[10]), (None, None), (10, texts[10]), (10, texts[10])]
    docs = spark.createDataFrame([(i, t, "s", 1, "w", 2, 3, "r", 0.5) for i, t in rows], SCHEMA).repartition(3)
    assert check_runs(spark, docs, str(tmp_path)) > 100


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9), st.sampled_from(["few", "units", "fibonacci", "morse", "nested", "thirds"]))
def test_runs_like_comparing_all(seed, kind):
    draw = random.Random(seed)
    n, k = draw.randrange(1, 400), draw.choice([1, 2, 2, 3, 5])
    if kind == "few":
        words = [draw.randrange(k) for _ in range(n)]
    elif kind == "units":
        words = []
        while len(words) < n:
            unit = [draw.randrange(k) for _ in range(draw.randrange(1, 60))]
            words += (unit * 8)[: draw.randrange(1, len(unit) * 8)]
    elif kind == "fibonacci":
        a, words = [0], [0, 1]
        while len(words) < n:
            a, words = words, words + a
    elif kind == "morse":
        words = [bin(i).count("1") % 2 for i in range(n)] * draw.randrange(1, 4)
    elif kind == "nested":
        words = (([0] * draw.randrange(1, 40) + [1]) * 3 + [2]) * draw.randrange(1, 12)
    else:
        unit = [draw.randrange(1000) for _ in range(n // 4 + 1)]
        words = unit * 3 + unit[: draw.randrange(len(unit) + 1)]
    if draw.random() < 0.4:
        words[draw.randrange(len(words))] = 7
    assert [tuple(r) for r in periodic_runs.runs(np.array(words)).tolist()] == plain_runs(words)


def test_hashes_that_mislead_cost_no_result(monkeypatch):
    """With hashes of three bits nearly every comparison by hash is wrong."""
    monkeypatch.setattr(periodic_runs, "run_hash", lambda sums, b, e: sums[e] * np.uint64(0) + np.uint64(1))
    words = [3, 4] * 40 + list(range(100, 130)) * 4 + list(range(17)) * 5
    assert {tuple(r) for r in periodic_runs.runs(np.array(words)).tolist()} == set(plain_runs(words))


def test_a_very_long_text_takes_seconds(spark):
    text = "a b c d e f g h i j k l m n o p q r s t " * 50_000 + " ".join(map(str, range(300_000)))
    started = datetime.datetime.now()
    row = periodic_runs.collapse_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(0, 1_000_000, 20)] and row.n_words == 1_300_000
    assert len(row.collapsed.split()) == 300_020
    assert datetime.datetime.now() - started < datetime.timedelta(seconds=120)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(none).collect() == [] and periodic_runs.collapse_runs(none).collect() == []
