"""Personal data: known forms by pattern, near forms by boosted trees. SQL functions only on the
rows; the trees are fitted on the driver, from a bounded sample of candidates' numbers.

Generators with a high recall propose spans that may overlap: anything around an at sign, and
long chains of digits with the usual separators. Each candidate gets features of its form
(lengths, digits, separators) and of the words before it, but none that restates a base pattern,
such as the plus sign, which separators are used, or the check digit: a candidate of a near form in
the same context looks the same. Boosted trees learn from the candidates themselves: those that a
validated base span covers are positive, all others unlabelled. Half of the sample is kept aside to
calibrate the scores. There, the mean score of the base hits is the share of personal data that is
labelled, and a score over that share the chance that an unlabelled candidate is personal data; the
least threshold counts at which the wanted share of the unlabelled candidates it selects is right.
This holds as far as base hits are like other personal data in these features. Candidates above the
threshold are added where no base span lies. The trees become one SQL expression.

Documents are scanned once and never shuffled: their spans and candidates are a table of their own,
from which the trees learn and the result is made. The sample is at most ``SAMPLE`` different
candidates, those with the smallest hash; counts of hashes per halving of their range tell which
may be among them, so what reaches the driver does not grow with the documents.

Defined results: a null or empty text has no spans; without candidates of both kinds nothing is
added; repeated rows are scanned each; a candidate whose score equals the threshold is added, and of equally good
splits the first feature's is taken; a very long text is scanned whole, by expressions that take time in proportion
to it; an empty table gives no rows; other columns are ignored. A
control character U+0001 in a text counts as one character of no kind.
"""

from __future__ import annotations

import functools
import operator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.spans import apart, fenceless, marked, parts, spans, told

KINDS = ("email", "ip", "card", "phone", "other")
# The base forms. A start inside a run is excluded where it could not match anyway.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)(?:\.[A-Za-z0-9-]++)*+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"

# The generators: around an at sign, chains of digits.
AROUND_AT = r"[^\s@<>\x01]{1,64}+@[^\s@<>\x01]{1,128}+"
DIGITS = r"\+?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,30}+"
WORDS = ("call|tele|phone|tel|fax|mobile", "e?-?mail|contact|write|reach", "card|visa|account", "address|server|host|login")

SAMPLE = 4000
TREES, DEPTH, RATE, CUTS = 24, 3, 0.3, 16
# Share of selected unlabelled candidates that must be right, and least chance of one in any case.
PRECISION, LEAST = 0.98, 0.5


def digits(found: Column) -> Column:
    return F.regexp_replace(found, F.lit("[^0-9]"), F.lit(""))


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.char_length(number)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(number, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), F.lit(0), add) % 10 == 0


def features(s: Column) -> list[Column]:
    """Numbers that tell a candidate's form and context."""
    found, before = s["found"], F.lower(s["before"])
    number = digits(found)
    flag = lambda condition: F.when(condition, 1).otherwise(0)
    groups = F.transform(F.split(found, "[^0-9]+"), F.char_length)
    return [
        F.char_length(F.regexp_replace(found, F.lit("[^A-Za-z]"), F.lit(""))),
        flag(F.char_length(number) < 8),
        flag(F.char_length(number).between(16, 19)),
        flag(F.char_length(number) > 19),
        F.least(F.array_max(groups), F.lit(8)),
        flag(found.contains("@")),
        *(flag(before.rlike(rf"\b(?:{words})")) for words in WORDS),
        flag(before.rlike("[A-Za-z0-9]$")),
        flag(before.rlike("[\\s:(]$")),
    ]


class Trees:
    """Boosted regression trees on the logistic loss, and the calibration of their sum; ``y`` is 1 for
    the positive rows and 0 for those without a label."""

    def __init__(self):
        self.trees: list = []
        self.scale, self.shift, self.threshold = 1.0, 0.0, float("inf")

    def fit(self, x: np.ndarray, y: np.ndarray, held: np.ndarray) -> Trees:
        train = ~held
        if not len(y) or not 0 < y[train].sum() < train.sum() or not 0 < y[held].sum() < held.sum():
            return self
        margin = np.zeros(len(y))
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            tree = _grow(x[train], (y - p)[train], (p * (1 - p))[train], DEPTH)
            self.trees.append(tree)
            margin = margin + _apply(tree, x)
        design = np.stack([margin[held], np.ones(held.sum())])
        fitted = np.array([1.0, 0.0])
        for _ in range(30):  # Newton steps of a ridged logistic fit on the held-out half
            p = 1 / (1 + np.exp(-np.clip(fitted @ design, -30, 30)))
            slope = design @ (y[held] - p) - (fitted - [1.0, 0.0])
            fitted = fitted + 0.5 * np.linalg.solve((design * (p * (1 - p))) @ design.T + np.eye(2), slope)
        self.scale, self.shift = map(float, fitted)
        p = 1 / (1 + np.exp(-np.clip(fitted @ design, -30, 30)))
        # Base hits are the labelled share of all personal data.
        chance = np.minimum(p / p[y[held] == 1].mean(), 1.0)
        for t in np.unique(p[chance >= LEAST]):
            selected = chance[(p >= t) & (y[held] == 0)]
            if not len(selected) or selected.mean() >= PRECISION:
                self.threshold = float(t)
                break
        return self

    def expression(self, x: list[Column]) -> Column:
        """Whether a candidate's calibrated score reaches the threshold."""
        if not self.trees or self.threshold == float("inf"):
            return F.lit(False)
        margin = functools.reduce(operator.add, (_sql(t, x) for t in self.trees))
        return 1 / (1 + F.exp(-(margin * float(self.scale) + float(self.shift)))) >= self.threshold - 1e-9


def _grow(x: np.ndarray, slope: np.ndarray, weight: np.ndarray, depth: int):
    def gain(s, w):
        return s * s / (w + 1.0)

    best = (1e-6, None, None)
    if depth and len(slope) >= 20:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            cuts = values[:-1] if len(values) <= CUTS else np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 1)[1:-1]))
            for cut in cuts:
                left = x[:, f] <= cut
                found = gain(slope[left].sum(), weight[left].sum()) + gain(slope[~left].sum(), weight[~left].sum())
                found -= gain(slope.sum(), weight.sum())
                if found > best[0]:
                    best = (found, f, float(cut))
    if best[1] is None:
        return RATE * float(slope.sum() / (weight.sum() + 1.0))
    left = x[:, best[1]] <= best[2]
    return best[1], best[2], _grow(x[left], slope[left], weight[left], depth - 1), _grow(x[~left], slope[~left], weight[~left], depth - 1)


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    return np.where(x[:, tree[0]] <= tree[1], _apply(tree[2], x), _apply(tree[3], x))


def _sql(tree, x: list[Column]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(x[tree[0]] <= tree[1], _sql(tree[2], x)).otherwise(_sql(tree[3], x))


def proposed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per row the ``base`` spans of each kind and the ``candidates``."""
    named = docs.select(F.col(id_column).alias("doc_id"), fenceless(F.col(text_column)).alias("clean_text"))
    patterns = (EMAIL, IP, CARD, PHONE, AROUND_AT, DIGITS)
    cut = named.withColumns({f"cut_{k}": parts(F.col("clean_text"), p) for k, p in enumerate(patterns)})
    enough = lambda s: F.char_length(digits(s)).between(8, 15)
    return cut.withColumns(
        {
            "email": spans(F.col("cut_0"), 0),
            "ip": spans(F.col("cut_1"), 1, lambda s: s.rlike(OCTETS)),
            "card": spans(F.col("cut_2"), 2, lambda s: luhn(digits(s))),
            "phone": spans(F.col("cut_3"), 3, enough),
            "candidates": F.concat(spans(F.col("cut_4"), 4), spans(F.col("cut_5"), 4)),
        }
    ).withColumn("base", F.concat("email", "ip", "card", "phone")).select("doc_id", *KINDS[:4], "base", "candidates")


def _hash_limit(hashed: DataFrame, sample: int) -> int:
    """A bound below which the ``sample`` smallest different hashes ``h`` lie, and few others.

    Hashes are counted by how many halvings of their range lie above them: 64 counts, whatever the
    number of candidates. The counts are approximate, so twice the sample is asked for."""
    above = F.col("h") - F.lit(-(1 << 63)).cast("decimal(20,0)")
    halvings = F.floor(F.lit(64.0) - F.log2(above.cast("double") + 1)).cast("int")
    seen = hashed.groupBy(halvings.alias("halvings")).agg(F.approx_count_distinct("h").alias("n")).collect()
    counts = {r.halvings: r.n for r in seen}
    below = 0
    for k in range(64, 0, -1):
        below += counts.get(k, 0)
        if below >= 2 * sample:
            return -(1 << 63) + (1 << (64 - k)) - 1
    return (1 << 63) - 1


def learn(found: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from a bounded sample of the different candidates."""
    each = found.select(F.explode(marked(F.col("candidates"), F.col("base"))).alias("m")).select("m.meets", F.col("m.span").alias("c"))
    covered = F.col("meets")
    chosen = F.xxhash64("c.found", "c.before", "c.start")
    told_apart = each.select(chosen.alias("h"), covered.alias("y"), F.col("c"))
    # Copies fold in the tasks, and only hashes near the wanted number leave them.
    few = told_apart.filter(F.col("h") <= _hash_limit(told_apart, sample)).distinct().orderBy("h", "c", "y").limit(sample)
    rows = few.select("h", "y", F.array(*(f.cast("double") for f in features(F.col("c")))).alias("x")).collect()
    x = np.array([r.x for r in rows]) if rows else np.zeros((0, 1))
    return Trees().fit(x, np.array([float(r.y) for r in rows]), np.array([r.h >> 8 & 1 == 1 for r in rows], bool))


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE) -> DataFrame:
    """Per row the base spans of each kind, and ``found``, all spans by kind, then start."""
    both = stored(proposed(docs, id_column, text_column), "candidates")
    trees = learn(both, sample)
    chosen = F.filter("candidates", lambda s: trees.expression([f.cast("double") for f in features(s)]))
    by_kind = lambda a, b: F.when(a["kind"] != b["kind"], a["kind"] - b["kind"]).otherwise(a["start"] - b["start"])
    added = F.array_distinct(apart(chosen, F.col("base")))
    return both.withColumn("found", F.array_sort(F.concat("base", added), by_kind))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = find(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:4]),
        F.sha2(told(F.col("base"), KINDS), 256).alias("base_sha256"),
        told(F.col("found"), KINDS).alias("spans"),
    )
