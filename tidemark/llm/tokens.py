"""Token ids of whole texts, by a tokenizers file with a byte-level BPE.

Merges never cross the words that the tokenizer splits a text into, so ids are found per word:
a numpy pass finds the words of many texts at once and looks them up in a table of known words;
only unknown words go to the tokenizers library. The file's added tokens (such as an end of text) are
cut out of the texts first and are one id each, as the library has them. The table has a fixed number of places, and a
newer word takes an older one's place, so memory is bounded.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import regex

from tidemark.llm.common import prefix_hash, run_hash

# The classes and contractions of the byte-level splitting pattern.
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
SHORT = "'s 't 'm 'd"
LONG = "'re 've 'll"

# Most characters of one pass, places in the word table, longest word that is kept there.
PASS_CHARS = 250_000
PLACES = 1 << 20
KEPT_CHARS = 64

_CUT = re.compile(r"(?<=\S) (?=\S)")


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            lo, hi = found.span()
            table[[ord(c) for c in every[lo:hi]]] = kind
    return table


class Encoder:
    """``encode`` turns texts into ids; made once per Python worker by ``encoder``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = {t.content: (i, t) for i, t in self.library.get_added_tokens_decoder().items() if t.content}
        self.added = {content: i for content, (i, _) in added.items()}
        # Whether they match as plain text; else the library takes the texts that hold one.
        self.exact = not any(t.single_word or t.lstrip or t.rstrip for _, t in added.values())
        # The leftmost, and of several there the longest.
        self.cut = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.keys = np.zeros(PLACES, np.uint64)
        self.first = np.zeros(PLACES, np.int64)
        self.count = np.zeros(PLACES, np.int64)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.filled = 0

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.library.encode_batch(words, add_special_tokens=False)]
        return (np.fromiter((i for ids in found for i in ids), np.uint32), np.fromiter(map(len, found), np.int64, len(found)))

    def _room(self, n: int) -> None:
        if self.filled + n > max(len(self.pool), 16 * PLACES):
            self.keys[:] = 0
            self.filled = 0
        while self.filled + n > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])

    def _pass(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.concatenate([[0], np.cumsum(lengths)])
        counts = np.zeros(len(texts), np.int64)
        if not joined:
            return np.zeros(0, np.uint32), counts
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = np.flatnonzero(word_starts(points, starts))
        end = np.append(begin[1:], len(points))
        keys = run_hash(prefix_hash(points), begin, end) | np.uint64(1)
        place = (keys >> np.uint64(8)).astype(np.int64) & (PLACES - 1)
        known = self.keys[place] == keys
        first, count = self.first[place], self.count[place]
        extra = np.zeros(0, np.uint32)
        if not known.all():
            new = np.flatnonzero(~known)
            _, at, back = np.unique(keys[new], return_index=True, return_inverse=True)
            sample = new[at]
            ids, sizes = self._ids([joined[b:e] for b, e in zip(begin[sample].tolist(), end[sample].tolist())])
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            extra, first[new], count[new] = ids, begins[back], sizes[back]
        pieces = [(known, self.pool)] if known.all() else [(known, self.pool), (~known, extra)]
        out = np.empty(int(count.sum()), np.uint32)
        target = np.concatenate([[0], np.cumsum(count)])
        for chosen, pool in pieces:
            n = count[chosen]
            within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(target[:-1][chosen], n) + within] = pool[np.repeat(first[chosen], n) + within]
        if len(extra):
            kept = (end[sample] - begin[sample]) <= KEPT_CHARS
            taken = np.flatnonzero(kept)
            self._room(len(extra))
            self.pool[self.filled : self.filled + len(extra)] = extra
            spot = place[sample[taken]]
            self.keys[spot], self.first[spot], self.count[spot] = keys[sample[taken]], begins[taken] + self.filled, sizes[taken]
            # Two new words of one place: the last write of each array is the same one.
            self.filled += len(extra)
        return out, target[np.searchsorted(begin, starts[1:])] - target[np.searchsorted(begin, starts[:-1])]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        if self.cut is None or not any(map(self.cut.search, texts)):
            return self._plain(texts)
        pieces: list[str] = []
        row: list[int] = []
        after: list[int] = []  # the piece that each added token follows
        tokens: list[int] = []
        for k, text in enumerate(texts):
            at = 0
            if not self.exact and self.cut.search(text):
                whole = self.library.encode(text, add_special_tokens=False).ids
                after += [len(pieces)] * len(whole)
                tokens += whole
                text = ""
            for found in self.cut.finditer(text):
                after.append(len(pieces))
                tokens.append(self.added[found[0]])
                pieces.append(text[at : found.start()])
                row.append(k)
                at = found.end()
            pieces.append(text[at:])
            row.append(k)
        ids, n = self._plain(pieces)
        ids = np.insert(ids, np.cumsum(n)[after], np.array(tokens, np.uint32))
        np.add.at(n, after, 1)
        return ids, np.bincount(row, n, len(texts)).astype(np.int64)

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of texts without added tokens."""
        counts = np.zeros(len(texts), np.int64)
        ids: list[np.ndarray] = []
        for rows, pieces in _passes(texts):
            found, n = self._pass(pieces)
            ids.append(found)
            np.add.at(counts, rows, n)
        return (np.concatenate(ids) if ids else np.zeros(0, np.uint32)), counts


def _passes(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Rows and texts in runs of up to ``PASS_CHARS``; longer texts are cut before a single space
    between two words, where a word always ends."""
    rows: list[int] = []
    pieces: list[str] = []
    size = 0
    for row, text in enumerate(texts):
        at = 0
        while at < len(text) or not text:
            cut = _CUT.search(text, at + PASS_CHARS - 1) if len(text) - at > PASS_CHARS else None
            piece = text[at : cut.start()] if cut else text[at:]
            if size and size + len(piece) > PASS_CHARS:
                yield rows, pieces
                rows, pieces, size = [], [], 0
            rows.append(row)
            pieces.append(piece)
            size += len(piece)
            at += len(piece)
            if not text:
                break
    if rows:
        yield rows, pieces


def word_starts(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Marks the code points at which the splitting pattern starts a word; the first code point
    of each text starts one."""
    n = len(points)
    kind = _classes()[points]
    space = kind == SPACE
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    edge = edge[:n]
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 255, kind[:-1]
    before[edge] = 255
    plain = np.zeros(n, bool)  # a space that joins the word after it
    plain[:-1] = (points[:-1] == 32) & ~space[1:] & ~edge[1:]
    last = np.zeros(n, bool)  # the last of a run of white space that a word follows
    last[:-1] = space[:-1] & ~space[1:] & ~edge[1:]
    begin = np.where(space, (before != SPACE) | last, kind != before)
    begin[1:] &= ~(plain[:-1] & ~edge[1:])
    quote = np.flatnonzero((points == 39) & ((before == LETTER) | (before == NUMBER) | (before == SPACE) | (before == 255)))
    if len(quote):
        joined = np.zeros(len(quote), bool)
        joined[quote > 0] = plain[quote[quote > 0] - 1]
        quote = quote[~joined | edge[quote]]
        stop = starts[np.searchsorted(starts, quote, side="right")]
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        size = np.zeros(len(quote), np.int64)
        for word in (SHORT + " " + LONG).split():
            same = quote + len(word) <= stop
            for k in range(1, len(word)):
                same &= padded[quote + k] == ord(word[k])
            size[same] = len(word)
        quote, size, stop = quote[size > 0], size[size > 0], stop[size > 0]
        begin[quote + 1] = False
        after = quote + size
        inner = after[after < stop]
        # White space after a contraction follows its own rule; anything else starts a word.
        begin[inner[~space[inner]]] = True
    begin[edge] = True
    return begin


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The file of a public tokenizer; its vocabulary is never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)
