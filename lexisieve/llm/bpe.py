"""Byte-level BPE encoding and decoding by a dynamic programme over byte prefixes.

For every prefix of a piece the last token of its encoding is unique: it is the one
token that ends there and goes together with the last token of what stands before it.
Two tokens go together if encoding their joined bytes gives these two back. Storing the
last token of each prefix gives the encoding of every prefix, so bytes are appended
without looking at earlier ones again, and after an edit only the places near it are
computed anew (`PrefixTable`, `EncodedText`).

A column's texts are cut into pieces by a pattern, and the last tokens of their prefixes
are shared between pieces that start alike.

Ranks come from a file (one base64 token and its rank a line), read once per Python
worker from ``path``, which every executor must have. Last tokens, pairs that go together
and the encodings of pieces are kept in tables of at most ``MOST_PREFIXES``, ``MOST_PAIRS``
and ``MOST_PIECES`` entries (about 100 MB in all); `encode_rows` frees them at the end of
each task. Pieces of more than ``LONG_PIECE`` bytes keep the last tokens of their prefixes
in a list of their own; their encoding is the same.

Defined results: null text is encoded as empty; null ids are decoded as no bytes; the
encoding of a text does not depend on other rows; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexisieve.llm.common import free_memory

MOST_PIECES, MOST_PREFIXES, MOST_PAIRS = 400_000, 150_000, 200_000
SLICE = 256
LONG_PIECE = 64
FOREVER = 1 << 60


class _Table(dict):
    """A dictionary that computes what it lacks.

    It and the ``older`` one, from which it takes what is asked for again, hold at most
    ``most`` entries together.
    """

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most, self.older = compute, most, {}

    def forget(self) -> None:
        self.older = {}
        self.clear()

    def __missing__(self, key):
        if 2 * len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value


class BytePairs:
    """Ranks, and which tokens go together."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.split = regex.compile(pattern).findall
        self.edges = _Table(self._edges, MOST_PAIRS)
        self.together = _Table(self._together, MOST_PAIRS)
        self.lasts = _Table(self._last_of, MOST_PREFIXES)
        self.pieces = _Table(self._piece, MOST_PIECES)

    def forget(self) -> None:
        """Free all tables but the ranks."""
        for table in (self.edges, self.together, self.lasts, self.pieces):
            table.forget()

    def _merges(self, token: bytes) -> tuple[list, list]:
        """Merge ``token`` as BPE does: what is left, and each part's ``(start, end, born, gone)``."""
        parts = [(i, i + 1, -1) for i in range(len(token))]
        history = []
        while len(parts) > 1:
            rank, at = min(
                (self.ranks.get(token[parts[i][0] : parts[i + 1][1]], FOREVER), i)
                for i in range(len(parts) - 1)
            )
            if rank == FOREVER:
                break
            history += [(*parts[at], rank), (*parts[at + 1], rank)]
            parts[at : at + 2] = [(parts[at][0], parts[at + 1][1], rank)]
        return parts, [*history, *((*p, FOREVER) for p in parts)]

    def _edges(self, rank: int):
        """``(parts at the left end, parts at the right end)`` as ``(bytes, born, gone)``.

        None for a token that its own bytes are not merged into.
        """
        token = self.bytes_of[rank]
        parts, history = self._merges(token)
        if len(parts) > 1:
            return None
        left = [(token[a:b], born, gone) for a, b, born, gone in history if a == 0]
        right = [(token[a:b], born, gone) for a, b, born, gone in history if b == len(token)]
        return left, right

    def _together(self, pair: tuple[int, int]) -> bool:
        """Whether no merge crosses the border while both sides grow.

        Of merges of one rank the one further left comes first.
        """
        first, second = self.edges[pair[0]], self.edges[pair[1]]
        for x, x_born, x_gone in first[1]:
            for y, y_born, y_gone in second[0]:
                rank = self.ranks.get(x + y)
                if rank is not None:
                    time = max(rank, x_born, y_born)
                    if time < x_gone and time <= y_gone:
                        return False
        return True

    def last_token(self, piece: bytes, end: int, last: list[int]) -> int:
        """The last token of ``piece[:end]``; ``last[i]`` is that of ``piece[:i]``."""
        ranks, together, edges = self.ranks, self.together, self.edges
        for start in range(max(0, end - self.longest), end):
            rank = ranks.get(piece[start:end])
            if rank is not None:
                if start:
                    if edges[rank] is not None and together[last[start], rank]:
                        return rank
                elif edges[rank] is not None:
                    return rank
        raise ValueError(f"no token for byte {piece[end - 1]}")

    def _last_of(self, prefix: bytes) -> int:
        """The last token of ``prefix``, which later pieces with this start use again.

        Shorter prefixes are looked at only where a token that ends the prefix leaves off.
        """
        ranks, edges = self.ranks, self.edges
        for start in range(max(0, len(prefix) - self.longest), len(prefix)):
            end = prefix[start:]
            if end in ranks:
                rank = ranks[end]
                if edges[rank] is not None and (not start or self.together[self.lasts[prefix[:start]], rank]):
                    return rank
        raise ValueError(f"no token for byte {prefix[-1]}")

    def encode_bytes(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > LONG_PIECE:
            return PrefixTable(self, piece).tokens()
        out = [self._last_of(piece)]  # a whole piece is kept as one, in `pieces`
        rest = piece[: -len(self.bytes_of[out[0]])]
        while rest:
            out.append(self.lasts[rest])
            rest = rest[: -len(self.bytes_of[out[-1]])]
        return out[::-1]

    def walk_back(self, last: list[int], end: int) -> list[int]:
        out = []
        while end:
            out.append(last[end])
            end -= len(self.bytes_of[last[end]])
        return out[::-1]

    def _piece(self, piece: str) -> bytes:
        return array("i", self.encode_bytes(piece.encode())).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as packed 32-bit numbers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))


class PrefixTable:
    """The encodings of all prefixes of a byte string that grows and is edited.

    The whole string is taken as one piece.
    """

    def __init__(self, pairs: BytePairs, piece: bytes = b""):
        self.pairs, self.piece, self.last = pairs, b"", [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        first = len(self.piece) + 1
        self.piece += more
        for end in range(first, len(self.piece) + 1):
            self.last.append(self.pairs.last_token(self.piece, end, self.last))

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes, of all without ``end``."""
        return self.pairs.walk_back(self.last, len(self.piece) if end is None else end)

    def edit(self, start: int, stop: int, new: bytes) -> int:
        """Replace ``piece[start:stop]``; returns how many places were computed anew.

        Once as many places in a row as the longest token has bytes hold the same tokens
        as before the edit, all later ones do.
        """
        old, shift = self.last, len(new) - (stop - start)
        self.piece = self.piece[:start] + new + self.piece[stop:]
        self.last, same = old[: start + 1], 0
        for end in range(start + 1, len(self.piece) + 1):
            self.last.append(self.pairs.last_token(self.piece, end, self.last))
            after = end - (start + len(new))
            same = same + 1 if after > 0 and self.last[end] == old[end - shift] else 0
            if same >= self.pairs.longest:
                self.last += old[end - shift + 1 :]
                return end - start
        return len(self.piece) - start


class EncodedText:
    """A text and its pieces' tokens; appending looks at the last pieces only."""

    LOOK_BACK = 3  # an apostrophe and a letter may become one piece with the next letter

    def __init__(self, pairs: BytePairs, text: str = ""):
        self.pairs, self.pieces, self.ids = pairs, [], []
        self.append(text)

    def append(self, more: str) -> None:
        text = "".join(self.pieces[-self.LOOK_BACK :]) + more
        del self.pieces[-self.LOOK_BACK :], self.ids[-self.LOOK_BACK :]
        for piece in self.pairs.split(text):
            self.pieces.append(piece)
            self.ids.append(self.pairs.encode_bytes(piece.encode()))

    def tokens(self) -> list[int]:
        return [i for ids in self.ids for i in ids]


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> BytePairs:
    """Ranks from a file, read once per process."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return BytePairs(ranks, pattern)


def _packed_lists(packed: list[bytes]) -> pa.ListArray:
    """Packed 32-bit numbers as rows of a list column."""
    offsets = np.zeros(len(packed) + 1, np.int64)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    ids = pa.array(np.frombuffer(b"".join(packed), np.int32))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), ids)


def encode_rows(
    docs: DataFrame, keep: list[str], path: str, pattern: str, text_col: str = "text"
) -> DataFrame:
    """The columns ``keep`` of ``docs``, the ``ids`` of each text, and ``decoded``, the bytes they stand for.

    The way for whole tables: a task frees its tables when it ends, so a worker that waits
    for other work holds no more than the ranks.
    """
    given = docs.select(*keep, F.col(text_col).alias("_encoded_text"))
    schema = T.StructType(
        [*given.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = load(path, pattern)
        of = pairs.bytes_of.__getitem__
        try:
            for batch in batches:
                for at in range(0, len(batch), SLICE):
                    part = batch.slice(at, SLICE)
                    packed = [pairs.encode(t or "") for t in part.column(len(keep)).to_pylist()]
                    decoded = [b"".join(map(of, memoryview(p).cast("i"))) for p in packed]
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:-1], _packed_lists(packed), pa.array(decoded, pa.binary())],
                        names=[*keep, "ids", "decoded"],
                    )
        finally:
            pairs.forget()
            batch = part = None
            free_memory()

    return given.mapInArrow(run, schema)


def encode(text: Column, path: str, pattern: str) -> Column:
    """Token ids, ``array<int>``; each match of ``pattern`` is encoded on its own."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        pairs = load(path, pattern)
        return _packed_lists([pairs.encode(t or "") for t in texts.to_pylist()])

    return run(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that ``ids`` stand for."""

    @F.arrow_udf("binary")
    def run(rows: pa.Array) -> pa.Array:
        of = load(path, pattern).bytes_of.__getitem__
        ends = rows.offsets.to_numpy()
        values = rows.values.to_numpy(zero_copy_only=False)
        return pa.array(
            [b"".join(map(of, values[a:b].tolist())) for a, b in zip(ends, ends[1:])], pa.binary()
        )

    return run(ids)
