"""Periodic runs of words, found online by catchers over completed power-of-two blocks.

Words are appended to a `RunCatcher`. For each power of two ``m``, a block of ``m`` words
that starts at a multiple of ``m`` gets a catcher once it is complete. A square of period
``q`` with ``2m - 1 <= q <= 4m - 2`` has a whole block in its left half and a copy of it
``q`` words on, so the catcher looks at the newest ``m`` words while they lie that far from
its block, and retires. A suffix that equals the block is extended to both sides; if the
words ``q`` apart that are equal make a square, it is a run or a part of one. Matches that
reach the newest word stay open and grow with what is appended. A run of period ``q`` is
met under a multiple of ``q`` too; of equal stretches the smallest period is kept.

Equality of blocks and the lengths of extensions come from sums of hashes modulo 2**64.
Different hashes prove different words, so nothing is missed; what is reported is compared
word by word, so nothing is wrong. Words may be appended one by one or many at once, which
gives the same runs; catchers of one size are then advanced together.

Documents are one stream per ``GROUP_BYTES`` of text, with a separator between them that
equals no word. Nothing is shuffled, and a task holds a group and what its words need, or
one longer document.

Defined results: null and empty texts have no words and no run; texts of any length count
whole; a null id stays null (its text is never made periodic); repeated rows each give a
row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH = 12
GROUP_BYTES = 1 << 20
AT_ONCE = 1 << 21  # suffixes compared in one step
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
NO_RUNS = np.zeros((3, 0), np.int64)


def _mixed(ids: np.ndarray) -> np.ndarray:
    """64 well-mixed bits for each number."""
    x = ids.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, first: int, stop: int) -> np.ndarray:
    out = np.full(stop - first, base)
    if stop > first:
        out[0] = pow(int(base), first, 1 << 64)
    return np.cumprod(out, dtype=np.uint64)


class RunCatcher:
    """Runs of a growing stream of numbers; negative ones are separators and equal nothing."""

    def __init__(self, least_length: int = LEAST_LENGTH):
        self.least_length = least_length
        self.words = np.zeros(0, np.int64)
        self.sums = np.zeros(1, np.uint64)  # of word hashes times powers of BASE
        self.unshift = np.zeros(0, np.uint64)  # powers of INVERSE
        self.separators = np.zeros(0, np.int64)
        self.open = NO_RUNS  # (start, end, period) of matches that reach the newest word
        self.closed: list[np.ndarray] = []
        self.longest = self.unbroken = 0

    def append(self, ids: np.ndarray) -> None:
        """Advance all catchers over ``ids``."""
        before, after = len(self.words), len(self.words) + len(ids)
        if not len(ids):
            return
        breaks = np.flatnonzero(ids < 0)
        self.separators = np.r_[self.separators, before + breaks]
        lengths = np.diff(np.r_[-1 - self.unbroken, breaks, len(ids)]) - 1
        self.longest, self.unbroken = max(self.longest, int(lengths.max())), int(lengths[-1])
        self.words = np.r_[self.words, ids]
        self.unshift = np.r_[self.unshift, _powers(INVERSE, before, after)]
        hashes = _mixed(ids)
        # each separator differs from every word and every other separator
        hashes[breaks] = _mixed(before + breaks + (1 << 40))
        terms = hashes * _powers(BASE, before, after)
        self.sums = np.r_[self.sums, self.sums[-1] + np.cumsum(terms, dtype=np.uint64)]
        caught = [self._extended(self.open[0], self.open[0] + self.open[2], self.open[1] - self.open[0] - self.open[2])]
        size = 1
        while 3 * size - 1 <= self.longest:  # a suffix may equal a block before a square is whole
            caught += self._suffixes(size, before, after)
            size *= 2
        found = np.concatenate(caught, axis=1)
        reaches_end = found[1] == after
        self.open = _distinct(found[:, reaches_end])
        self.closed.append(_distinct(self._squares(found[:, ~reaches_end])))

    def _squares(self, matches: np.ndarray) -> np.ndarray:
        length = matches[1] - matches[0]
        return matches[:, (length >= self.least_length) & (length >= 2 * matches[2])]

    def _suffixes(self, size: int, before: int, after: int) -> list[np.ndarray]:
        """Matches of the blocks of ``size`` with the suffixes that came in between."""
        first = max(0, -((5 * size - 3 - before) // size))  # smallest block that still looks
        blocks = np.arange(first * size, after - 3 * size + 2, size)
        ends = np.r_[self.separators, after]
        place = np.searchsorted(self.separators, blocks)
        end, start = ends[place], np.r_[0, self.separators + 1][place]
        low = np.maximum(blocks + 2 * size - 1, before - size + 1)
        high = np.minimum(blocks + 4 * size - 2, end - size)
        growing = place == len(self.separators)  # the last document
        live = (low <= high) & (growing | (end - start >= max(4 * size - 2, self.least_length)))
        blocks, low, counts = blocks[live], low[live], (high - low + 1)[live]
        out = []
        for part in np.split(np.arange(len(blocks)), np.flatnonzero(np.diff(np.cumsum(counts) // AT_ONCE)) + 1):
            n = counts[part]
            if not n.sum():
                continue
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[part], n)
            hits = np.repeat(self._hashes(blocks[part], size), n) == self._hashes(at, size)
            if hits.any():
                out.append(self._extended(np.repeat(blocks[part], n)[hits], at[hits], size))
        return out

    def _hashes(self, at: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.unshift[at]

    def _extended(self, left: np.ndarray, right: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        """``(start, end, period)``: how far the words from ``left`` equal those from ``right``.

        ``size`` words are known to be equal; steps of halving length go on from there.
        """
        if not len(left):
            return NO_RUNS
        period, start, stop = right - left, left.copy(), right + size
        total = len(self.words)
        # most matches end at once: only those that go on take part in the steps
        more = np.flatnonzero((stop < total) & (self.words[np.minimum(stop, total - 1)] == self.words[stop - period]))
        more = more[self.words[stop[more]] >= 0]
        for length in _halving(self.longest):
            room = more[stop[more] + length <= total]
            if len(room):
                at = stop[room]
                same = self._hashes(at, length) == self._hashes(at - period[room], length)
                stop[room[same]] += length
        more = np.flatnonzero((start > 0) & (self.words[start - 1] == self.words[start + period - 1]))
        more = more[self.words[start[more] - 1] >= 0]
        for length in _halving(self.longest):
            room = more[start[more] >= length]
            if len(room):
                at = start[room] - length
                same = self._hashes(at, length) == self._hashes(at + period[room], length)
                start[room[same]] -= length
        return np.stack([start, stop, period])

    def runs(self) -> np.ndarray:
        """``(start, end, period)`` of all runs so far, by start and period."""
        found = np.concatenate([NO_RUNS, *self.closed, self._squares(self.open)], axis=1)
        checked = [self._compared(*match) for match in found.T]
        found = np.concatenate([NO_RUNS, *checked], axis=1)
        order = np.lexsort((found[2], found[1], found[0]))
        found = found[:, order]
        again = np.zeros(found.shape[1], bool)  # a multiple of the period of the same stretch
        again[1:] = (found[:2, 1:] == found[:2, :-1]).all(axis=0)
        found = found[:, ~again]
        return found[:, np.lexsort((found[2], found[0]))]

    def _compared(self, start: int, end: int, period: int) -> np.ndarray:
        """The stretches of a match that hold word by word: all of it, unless hashes collided."""
        same = self.words[start : end - period] == self.words[start + period : end]
        if same.all():
            return np.array([[start], [end], [period]])
        edges = np.flatnonzero(np.diff(np.r_[False, same, False]))
        return self._squares(np.stack([start + edges[::2], start + edges[1::2] + period, np.full(len(edges) // 2, period)]))


def _halving(longest: int) -> Iterator[int]:
    """Powers of two whose sums reach every number up to ``longest``."""
    step = 1 << max(longest.bit_length() - 1, 0)
    while step:
        yield step
        step //= 2


def _distinct(matches: np.ndarray) -> np.ndarray:
    matches = matches[:, np.lexsort(matches[::-1])]
    kept = np.ones(matches.shape[1], bool)
    kept[1:] = (matches[:, 1:] != matches[:, :-1]).any(axis=0)
    return matches[:, kept]


def made_periodic(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """One document in ten, by the checksum of its id, goes on with a few of its words."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + period] * (-(-(n - a) // period)))[: n - a]


def _groups(ids: list, texts: list[bytes | None]) -> Iterator[list[tuple]]:
    group, size = [], 0
    for doc_id, text in zip(ids, texts):
        group.append((doc_id, text or b""))
        size += len(text or b"")
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


SCHEMA = (
    "id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
    "collapsed binary, collapsed_sha256 string"
)


def _described(group: list[tuple], rewrite, keep_text: bool) -> list[tuple]:
    known: dict[bytes, int] = {}
    texts = [rewrite(text.split(), doc_id) for doc_id, text in group]
    starts = np.cumsum([0, *(len(words) + 1 for words in texts)])
    stream = np.full(starts[-1], -1, np.int64)
    for at, words in zip(starts, texts):
        stream[at : at + len(words)] = [known.setdefault(w, len(known)) for w in words]
    catcher = RunCatcher()
    catcher.append(stream)
    found = catcher.runs()
    gone = np.zeros(len(stream) + 1, np.int64)
    np.add.at(gone, found[0] + found[2], 1)
    np.add.at(gone, found[1], -1)
    kept = np.cumsum(gone) == 0
    bounds = np.searchsorted(found[0], starts)
    out = []
    for i, ((doc_id, _), words) in enumerate(zip(group, texts)):
        mine = found[:, bounds[i] : bounds[i + 1]]
        runs = [
            {"start": int(s - starts[i]), "length": int(e - s), "period": int(p)} for s, e, p in mine.T
        ]
        if runs:
            words = list(compress(words, kept[starts[i] : starts[i] + len(words)].tolist()))
        collapsed = b" ".join(words)
        out.append(
            (
                doc_id, len(texts[i]), runs, collapsed if keep_text else None,
                hashlib.sha256(collapsed).hexdigest(),
            )
        )
    return out


def word_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rewrite=lambda words, doc_id: words,
    keep_text: bool = True,
) -> DataFrame:
    """Per document ``(id, n_words, runs, collapsed, collapsed_sha256)``.

    ``runs`` are ``(start, length, period)`` by start, then period. ``collapsed`` are the words
    that no run contains after its first period, with one space between them (null without
    ``keep_text``). ``rewrite(words, id)`` may change a document's words first.
    """
    types = pa.schema(
        [
            ("id", pa.int64()),
            ("n_words", pa.int64()),
            ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
            ("collapsed", pa.binary()),
            ("collapsed_sha256", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                for group in _groups(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    rows = _described(group, rewrite, keep_text)
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), types)], schema=types)

    given = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return given.mapInArrow(run, SCHEMA)


def run_digests(found: DataFrame) -> DataFrame:
    """`word_runs` with its longest run in columns and digests of all of them."""
    # longest first, then smallest start, then smallest period
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))

    def long(value: Column) -> Column:
        return value.cast("bigint")

    return found.withColumn("_top", longest).select(
        F.col("id").alias("doc_id"),
        long(F.size("runs")).alias("n_runs"),
        F.col("_top.s").alias("start"),
        (-F.col("_top.l")).alias("length"),
        F.col("_top.p").alias("period"),
        long(F.floor(-F.col("_top.l") * 1000 / F.col("_top.p"))).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
