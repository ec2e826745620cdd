"""Secrets: known forms by pattern, others by a battery of randomness tests. SQL functions only.

Candidates are long unbroken tokens. Of a token its body counts: without short prefixes that end
in a dash, underscore or equals sign, and of hex in parts without the dashes. The body's encoding
is inferred from its characters (``ENCODINGS``), and its symbols' values are tested against uniform
noise: chi-squared of the symbol counts, number of runs above and below the middle, and serial
correlation, each as a normal score with the mean and spread for that length and alphabet, added
up to one chi-squared of three degrees with a p-value of its own. A token that looks like noise
must also be unlike text: a chain of character classes (vowels, consonants, capitals, digits) with
letter frequencies gives the chance of the body as text. The p-value that is controlled is that
chance over the body's chance as noise in its encoding times the battery's p-value. The latter two
add up to at most one over all bodies, so text has a ratio of x or less with a chance of at most x;
it falls with length. In each band of lengths these p-values of all documents' tokens go through
the Benjamini-Hochberg procedure, from counts per band and bin of the p-value (a fixed number of
rows, whatever the data).

Numbers of digits alone cannot be told from other long numbers and are never found so.

Documents are scanned twice and never shuffled.

Defined results: a null or empty text has no spans; repeated rows are scanned each, and count each
in the procedure; tokens with equal p-values are taken or left together; of spans that begin at one place the
kinds come as listed; a very long text is scanned whole, by expressions that take time in proportion to it; an
empty table gives no rows; other columns are kept aside. A control character
U+0001 in a text counts as one character of no kind.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.spans import apart, fenceless, parts, redacted, spans, told

KINDS = ("assign", "access", "hex", "random")
# The base forms.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
VALUE_CHARS = 6

TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
# Encodings, the first that fits counts: what its tokens look like, and its alphabet.
_LOW, _UP, _NUM = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = (
    ("^[0-9]+$", _NUM),
    ("^[0-9a-f]+$", _NUM + "abcdef"),
    ("^[0-9A-F]+$", _NUM + "ABCDEF"),
    ("^[a-z]+$", _LOW),
    ("^[A-Z]+$", _UP),
    ("^[A-Z2-7]+=*$", _UP + "234567"),
    ("^[a-z2-7]+=*$", _LOW + "234567"),
    ("^[a-z0-9]+$", _NUM + _LOW),
    ("^[A-Z0-9]+$", _NUM + _UP),
    ("^[A-Za-z]+$", _UP + _LOW),
    ("^[A-Za-z0-9]+$", _NUM + _UP + _LOW),
    ("^[A-Za-z0-9+/]+=*$", _UP + _LOW + _NUM + "+/"),
    ("^[A-Za-z0-9_-]+=*$", _UP + _LOW + _NUM + "-_"),
    (".", _UP + _LOW + _NUM + "-_+/="),
)
# Short prefixes before a body without separators; parts of hex after such prefixes.
PREFIX = r"^(?:[A-Za-z0-9]{1,10}[-_=]){1,3}(?=[A-Za-z0-9+/]{16,}=*$)"
HEX_PARTS = r"^(?:[A-Za-z]{1,10}[-_=]){0,2}((?:[0-9a-f]+-)+[0-9a-f]+|(?:[0-9A-F]+-)+[0-9A-F]+)$"
# Upper bounds of the length bands; share of false discoveries.
BANDS = (24, 32, 48, 96)
RATE = 0.01
# Text: changes of character class per step, vowels after a vowel, after a consonant and first in a
# class, and how often letters are used, with a floor for the rare ones.
TEXT_CHANGES = 0.08
VOWELS = (0.2, 0.58, 0.4)
USED = dict(zip("etaoinshrdlcumwfgypbvkjxqz", (127, 91, 82, 75, 70, 67, 63, 61, 60, 43, 40, 28, 28, 24, 24, 22, 20, 20, 19, 15, 10, 8, 8, 8, 8, 8)))
# Bins of -ln p, and how many.
BIN, BINS = 0.25, 400


def _clamped(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(-60.0)), F.lit(60.0))


def body(token: Column) -> Column:
    """The part of a token that may be noise."""
    hexes = F.regexp_extract(token, HEX_PARTS, 1)
    return F.when(hexes != "", F.translate(hexes, "-", "")).otherwise(F.regexp_replace(token, F.lit(PREFIX), F.lit("")))


def _alphabet(token: Column) -> Column:
    alphabet = F.lit(ENCODINGS[-1][1])
    for form, letters in reversed(ENCODINGS[:-1]):
        alphabet = F.when(token.rlike(form), F.lit(letters)).otherwise(alphabet)
    return alphabet


def noise_score(token: Column) -> Column:
    """Sum of the three squared scores against uniform noise, in the token's own alphabet."""
    return _scores(F.rtrim(token, F.lit("=")), _alphabet(token))


def _scores(plain: Column, alphabet: Column) -> Column:
    holder = F.array(F.struct(plain.alias("t"), alphabet.alias("a")))
    # Symbol values once per token, then everything from them.
    valued = F.transform(
        holder,
        lambda h: F.struct(
            F.transform(F.filter(F.split(h["t"], ""), lambda c: c != ""), lambda c: F.position(c, h["a"]) - 1).alias("v"),
            F.char_length(h["a"]).cast("double").alias("k"),
        ),
    )

    def score(h: Column) -> Column:
        v, k = h["v"], h["k"]
        n = F.greatest(F.size(v), F.lit(2)).cast("double")  # a token of equals signs has no symbols
        middle = (k - 1) / 2
        squares = F.aggregate(
            F.sequence(F.lit(0), F.lit(max(len(a) for _, a in ENCODINGS) - 1)),
            F.lit(0.0),
            lambda s, i: s + F.pow(F.size(F.filter(v, lambda x: x == i)).cast("double"), F.lit(2.0)),
        )
        chi = (k / n * squares - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        high = F.size(F.filter(v, lambda x: x > middle)).cast("double")
        low = n - high
        zero = F.struct(F.lit(0.0).alias("runs"), F.lit(0.0).alias("cross"), F.lit(0.0).alias("square"), F.lit(None).cast("double").alias("last"))

        def step(a: Column, x: Column) -> Column:
            d = x.cast("double") - middle
            turned = a["last"].isNull() | ((a["last"] > 0) != (d > 0))
            return F.struct(
                (a["runs"] + F.when(turned, 1.0).otherwise(0.0)).alias("runs"),
                (a["cross"] + F.coalesce(a["last"], F.lit(0.0)) * d).alias("cross"),
                (a["square"] + d * d).alias("square"),
                d.alias("last"),
            )

        walked = F.aggregate(v, zero, step)
        expected = 2 * high * low / n + 1
        spread = F.sqrt(F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-6)))
        runs = (walked["runs"] - expected) / spread
        serial = walked["cross"] / F.greatest(walked["square"], F.lit(1e-6)) * F.sqrt(n)
        return (
            F.pow(F.greatest(_clamped(chi), F.lit(0.0)), F.lit(2.0)) + F.pow(_clamped(runs), F.lit(2.0)) + F.pow(_clamped(serial), F.lit(2.0))
        )

    return F.get(F.transform(valued, score), F.lit(0))


def _text_model() -> tuple[str, list[int], list[float], list[float]]:
    """All symbols, the class of each, its cost (-ln of its share) there, and the costs of one class
    after another, by class times classes plus class. The last class is before the first symbol."""
    groups = ["aeiou", "".join(c for c in _LOW if c not in "aeiou")]
    groups += [g.upper() for g in groups] + [_NUM, "+/_=-"]
    kinds = [0, 0, 1, 1, 2, 3, None]
    symbols, classes, costs = "", [], []
    for number, group in enumerate(groups):
        shares = [USED.get(c.lower(), 1) for c in group]
        symbols += group
        classes += [number] * len(group)
        costs += [-math.log(n / sum(shares)) for n in shares]
    moves = []
    for last, before in enumerate(kinds):
        for to, kind in enumerate(kinds[:-1]):
            share = 0.25 if before is None else 1 - TEXT_CHANGES if kind == before else TEXT_CHANGES / 3
            if to < 4:
                vowel = VOWELS[last % 2] if kind == before else VOWELS[2]
                share *= 1 - vowel if to % 2 else vowel
            moves.append(-math.log(share))
    return symbols, classes, costs, moves


def text_cost(token: Column) -> Column:
    """-ln of a token's chance as text of its length."""
    symbols, classes, costs, moves = _text_model()
    n = max(classes) + 1
    class_of, cost_of, move = (F.array(*map(F.lit, x)) for x in (classes, costs, moves))
    zero = F.struct(F.lit(n).alias("last"), F.lit(0.0).alias("cost"))

    def step(a: Column, at: Column) -> Column:
        to = F.get(class_of, at)
        return F.struct(to.alias("last"), (a["cost"] + F.get(cost_of, at) + F.get(move, a["last"] * n + to)).alias("cost"))

    places = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.position(c, F.lit(symbols)) - 1)
    return F.aggregate(places, zero, step, lambda a: a["cost"])


def evidence(token: Column) -> Column:
    """-ln of the token's p-value (see above); negative for what is likelier as text."""
    plain = F.rtrim(token, F.lit("="))
    noise = F.char_length(plain) * F.ln(F.char_length(_alphabet(token))) + math.log(len(ENCODINGS))
    score = _scores(plain, _alphabet(token))
    # Upper bound of the chance of a chi-squared of three degrees above the score.
    battery = F.least(F.lit(0.0), F.ln(1 + F.sqrt(score * (2 / math.pi))) - score / 2)
    return text_cost(plain) - noise + battery


def _band(token: Column) -> Column:
    n = F.char_length(token)
    return sum(F.when(n >= bound, 1).otherwise(0) for bound in BANDS)


def _bin(token: Column) -> Column:
    looks = F.get(F.transform(F.array(body(token)), evidence), F.lit(0))
    return F.least(F.greatest(F.floor(F.coalesce(looks, F.lit(0.0)) / BIN), F.lit(0)), F.lit(BINS - 1)).cast("int")


def limits(tokens: DataFrame) -> list[int]:
    """Per length band the least bin of p-values that is a discovery, from ``band`` and ``bin``."""
    counts = {(r["band"], r["bin"]): r["count"] for r in tokens.groupBy("band", "bin").count().collect()}
    out = []
    for band in range(len(BANDS) + 1):
        total = sum(n for (b, _), n in counts.items() if b == band)
        above, least = 0, BINS
        for place in range(BINS - 1, 0, -1):
            above += counts.get((band, place), 0)
            # Every p-value of this bin and above is at most that of the bin's lower edge.
            if above and 2.718281828459045 ** (-place * BIN) <= RATE * above / total:
                least = place
        out.append(least)
    return out


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row ``base`` and ``found`` (all spans, sorted), besides the id and the columns to keep."""
    named = docs.select(F.col(id_column).alias("doc_id"), *keep, fenceless(F.col(text_column)).alias("clean_text"))
    tokens = named.select(F.explode(F.regexp_extract_all("clean_text", F.lit(TOKEN), F.lit(0))).alias("t"))
    least = limits(tokens.select(_band(F.col("t")).alias("band"), _bin(F.col("t")).alias("bin")))
    bounds = F.array(*map(F.lit, least))
    value = lambda part: F.char_length(F.regexp_extract(part, ASSIGN, 2)) >= VALUE_CHARS
    random = lambda part: _bin(part) >= F.get(bounds, _band(part))
    cut = named.withColumns({f"cut_{k}": parts(F.col("clean_text"), p) for k, p in enumerate((ASSIGN, ACCESS, HEX, TOKEN))})
    found = cut.withColumns(
        {
            "assign": spans(F.col("cut_0"), 0, value),
            "access": spans(F.col("cut_1"), 1),
            "hex": spans(F.col("cut_2"), 2),
            "random": spans(F.col("cut_3"), 3, random),
        }
    ).withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    return found.select(
        "doc_id",
        *keep,
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        "base",
        F.array_sort(F.concat("base", apart(F.col("random"), F.col("base")))).alias("found"),
    )


def redact(docs: DataFrame, sign: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs``, all columns, with every secret in ``text`` replaced by the sign."""
    order = docs.columns
    packed = docs.select("doc_id", "text", F.struct(*order).alias("whole_row"))
    scanned = scan(packed, keep=("whole_row",))
    text = F.col("whole_row.text")
    changed = F.when(text.isNotNull(), redacted(text, F.col("found"), sign)).alias("text")
    return scanned.select(*(changed if c == "text" else F.col(f"whole_row.{c}").alias(c) for c in order))


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(told(F.col("base"), KINDS), 256).alias("base_sha256"),
        told(F.col("found"), KINDS).alias("spans"),
    )
