"""Terms of documents, counted and weighed in blocks of documents.

A block holds documents of about ``BLOCK_CHARS`` characters, dealt by a hash of their ID. Its
words and n-grams are numbered inside the block, and documents are counted in integers; each
distinct n-gram becomes a string once a block. What is shuffled by term is one row for each term
of a block, not of a document: a vocabulary meets the blocks by that short list, and the block
gives its documents their weights. A task holds one block at a time.

Terms travel in lists: a block's terms of one hash bucket are one row of packed bytes. Buckets
are read in groups of about ``GROUP`` terms, in which terms are counted or meet a vocabulary as
arrays; neither is sorted as single rows.

Rows of one ID lie in one block; their terms are rows of their own, as the documents are, and
have one length together. Null texts have no terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lexisieve.functions.tokens import char_words, word_tokens
from lexisieve.session import materialize, store_bucketed

WORD, CHAR = "word", "char"
BLOCK_CHARS = 4_000_000
# N-gram occurrences sorted at once, and rows of a batch that goes back to Spark.
CHUNK, BATCH = 1 << 20, 1 << 16
# Counts below this have Spark's logarithm.
LOGS = 1 << 12
# Hash buckets of terms (at most 65,536), and terms that are counted or looked up together.
BUCKETS, GROUP = 1 << 13, 1 << 20
# Possible n-grams, beyond the n-grams to number, up to which numbers come from a table of flags.
FLAGS = 1 << 22
# Possible n-grams above which shorter n-grams are numbered before they are made longer.
NUMBERED = 1 << 16
LISTS = "bucket int, branch string, n bigint, terms binary, sizes binary, df binary"


@dataclass(frozen=True)
class BlockTerms:
    """``docs(block, doc, a text for each branch)`` and ``lists`` of each block's terms, both written."""

    docs: DataFrame
    lists: DataFrame
    ranges: dict[str, tuple[int, int]]
    doc_col: str

    @property
    def terms(self) -> DataFrame:
        """``(block, branch, term, df)``, one row for each term of a block."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = pa.Table.from_batches([batch])
                rows = pa.array(np.repeat(np.arange(len(lists)), lists.column("n").to_numpy()))
                yield from pa.table(
                    {
                        "block": lists.column("block").take(rows),
                        "branch": lists.column("branch").take(rows),
                        "term": _unlisted(lists).cast(pa.string()),
                        "df": pa.array(_bytes(lists.column("df"), np.int64)),
                    }
                ).to_batches(max_chunksize=BATCH)

        return self.lists.mapInArrow(run, "block int, branch string, term string, df bigint")


# --- inside a block ------------------------------------------------------------


def _pieces(texts: pa.ChunkedArray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The pieces of space-joined ``texts``: the number of their text, and the pieces."""
    lists = pc.split_pattern(texts.cast(pa.large_string()).combine_chunks(), " ")
    at, flat = pc.list_parent_indices(lists), pc.list_flatten(lists)
    there = pc.not_equal(flat, "")
    at, encoded = at.filter(there).to_numpy(), flat.filter(there).dictionary_encode()
    return at.astype(np.int64), encoded


def _codes(encoded: pa.DictionaryArray) -> np.ndarray:
    return encoded.indices.to_numpy().astype(np.int64)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``keys`` in order, and how often each occurs."""
    keys = np.sort(keys)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[starts], np.diff(np.append(starts, len(keys)))


def _numbered(keys: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``keys`` below ``bound`` in order, a place of each, and each key's number among them."""
    if bound > FLAGS + 4 * len(keys):
        return np.unique(keys, return_index=True, return_inverse=True)
    seen = np.zeros(bound, bool)
    seen[keys] = True
    distinct = np.flatnonzero(seen)
    numbers = np.zeros(bound, np.int32)
    numbers[distinct] = np.arange(len(distinct))
    own, place = numbers[keys], np.empty(len(distinct), np.int64)
    place[own] = np.arange(len(keys))
    return distinct, place, own


def _grams_of_words(words: pa.Array, low: int, high: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Character n-grams of padded words: where each word's begin, their numbers, the n-grams.

    An n-gram is known by its first character's number and those of the others after it.
    """
    joined = " " + "".join(f"{word} " for word in words.to_pylist())
    alphabet, _, symbols = _numbered(np.frombuffer(joined.encode("utf-32-le"), np.uint32), 0x110000)
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    firsts = np.cumsum(lengths + 1) - lengths - 1
    sizes = {n: np.maximum(lengths + 3 - n, 0) for n in range(low, high + 1)}
    starts = np.concatenate([[0], np.cumsum(sum(sizes.values()))])
    numbers, terms, known = np.zeros(starts[-1], np.int64), [], 0
    keys, bound, before = symbols.astype(np.int64), len(alphabet), starts[:-1].copy()
    for n in range(2, high + 1):
        if bound > NUMBERED:
            distinct, _, keys = _numbered(keys, bound)
            keys, bound = keys.astype(np.int64), len(distinct)
        keys = keys[:-1] * len(alphabet) + symbols[n - 1 :]
        bound *= len(alphabet)
        if n < low:
            continue
        word = np.repeat(np.arange(len(lengths)), sizes[n])
        inside = np.arange(len(word)) - (np.cumsum(sizes[n]) - sizes[n])[word]
        at = firsts[word] + inside
        distinct, first, own = _numbered(keys[at], bound)
        numbers[before[word] + inside] = known + own
        terms += [joined[a : a + n] for a in at[first].tolist()]
        known += len(distinct)
        before += sizes[n]
    return starts, numbers, pa.array(terms, pa.large_string())


def _spread(starts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each n-gram of ``words``: the place of its word among them, its own place in the list."""
    sizes = starts[words + 1] - starts[words]
    ends = np.cumsum(sizes)
    places = np.repeat(np.arange(len(words)), sizes)
    return places, np.arange(ends[-1] if len(ends) else 0) + (starts[words] - ends + sizes)[places]


def _char_terms(texts: pa.ChunkedArray, low: int, high: int):
    at, encoded = _pieces(texts)
    words = _codes(encoded)
    starts, numbers, terms = _grams_of_words(encoded.dictionary, low, high)
    many = max(len(terms), 1)
    # whole documents go into a chunk
    ends = np.cumsum(starts[words + 1] - starts[words])
    cuts, done = [0], 0
    while cuts[-1] < len(words):
        stop = np.searchsorted(ends, done + CHUNK, "right")
        stop = int(np.searchsorted(at, at[min(stop, len(at) - 1)], "right"))
        done = int(ends[stop - 1])
        cuts.append(stop)
    found = []
    for a, b in zip(cuts, cuts[1:]):
        places, listed = _spread(starts, words[a:b])
        found.append(_runs(at[a:b][places] * many + numbers[listed]))
    keys = np.concatenate([k for k, _ in found]) if found else np.zeros(0, np.int64)
    tf = np.concatenate([n for _, n in found]) if found else np.zeros(0, np.int64)
    return keys // many, keys % many, tf, terms


def _word_terms(texts: pa.ChunkedArray, low: int, high: int):
    at, encoded = _pieces(texts)
    words, dictionary = _codes(encoded), encoded.dictionary
    docs, numbers, terms, known = [], [], [], 0
    grams, strings = words, dictionary  # of one size, by the place of their first word
    here = np.arange(len(words))
    for size in range(1, high + 1):
        if size > 1:
            inside = here + size - 1 < len(words)
            inside[inside] = at[here[inside] + size - 1] == at[here[inside]]
            here, grams = here[inside], grams[inside]
            pairs = grams * len(dictionary) + words[here + size - 1]
            pairs, _, grams = _numbered(pairs, len(strings) * len(dictionary))
            grams = grams.astype(np.int64)
            left, right = pairs // max(len(dictionary), 1), pairs % max(len(dictionary), 1)
            strings = pc.binary_join_element_wise(
                strings.take(pa.array(left)), dictionary.take(pa.array(right)), pa.scalar(" ", pa.large_string())
            )
        if size >= low:
            docs.append(at[here])
            numbers.append(grams + known)
            terms.append(strings)
            known += len(strings)
    many = max(known, 1)
    keys, tf = _runs(np.concatenate(docs) * many + np.concatenate(numbers))
    return keys // many, keys % many, tf, pa.concat_arrays(terms)


def _found(table: pa.Table, ranges: dict[str, tuple[int, int]]):
    """For each branch: document numbers, term numbers and counts in order, and the terms."""
    for branch, (low, high) in ranges.items():
        yield branch, *(_word_terms if branch == WORD else _char_terms)(table.column(branch), low, high)


def _branch(name: str, n: int) -> pa.Array:
    return pa.DictionaryArray.from_arrays(pa.array(np.zeros(n, np.int32)), pa.array([name])).cast(pa.string())


def _bucket(terms: pa.Array) -> np.ndarray:
    """The hash bucket of each term, by its UTF-8 bytes alone."""
    found = np.empty(len(terms), np.uint16)
    for a in range(0, len(terms), BATCH):
        # a cast copies no slice, so offsets are taken where it begins
        part = terms.slice(a, BATCH)
        ends = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
        ends = ends - ends[0]
        sizes = np.diff(ends)
        powers = np.full(max(sizes.max(initial=0), 1), 0x9E3779B97F4A7C15, np.uint64).cumprod()
        sums = np.concatenate([[np.uint64(0)], ((data + 1) * powers[np.arange(len(data)) - np.repeat(ends[:-1], sizes)]).cumsum()])
        h = sums[ends[1:]] - sums[ends[:-1]]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        found[a : a + BATCH] = (h >> np.uint64(32)) % np.uint64(BUCKETS)
    return found


def _packed(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes of ``values`` in one row from each of ``starts`` to the next."""
    ends = np.append(starts, len(values)) * values.itemsize
    data = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _bytes(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """What `_packed` packed, of all rows."""
    held = column.cast(pa.large_binary()).combine_chunks()
    if not len(held):
        return np.zeros(0, kind)
    ends = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1]
    return np.frombuffer(np.frombuffer(held.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].tobytes(), kind)


def _term_bytes(terms: pa.Array, starts: np.ndarray) -> dict[str, pa.Array]:
    """``terms`` and their ``sizes``, in one row from each of ``starts`` to the next."""
    ends = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset : terms.offset + len(terms) + 1]
    data = np.frombuffer(terms.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return {
        "terms": _packed(data, ends[starts] - ends[0]),
        "sizes": _packed(np.diff(ends).astype(np.int32), starts),
    }


def _unlisted(lists: pa.Table) -> pa.Array:
    """The terms of lists, one after the other."""
    ends = np.concatenate([[0], np.cumsum(_bytes(lists.column("sizes"), np.int32), dtype=np.int64)])
    data = _bytes(lists.column("terms"), np.uint8)
    return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(data))


def _starts(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _counted(ranges: dict[str, tuple[int, int]], occurrences: bool = False):
    def run(table: pa.Table) -> pa.Table:
        block, parts = table.column("block")[0].as_py(), []
        for branch, _, numbers, tf, terms in _found(table, ranges):
            df = np.bincount(numbers, tf if occurrences else None, len(terms)).astype(np.int64)
            if not len(terms):
                continue
            bucket = _bucket(terms)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            starts = _starts(bucket)
            parts.append(
                pa.table(
                    {
                        "block": pa.array(np.full(len(starts), block), pa.int32()),
                        "bucket": pa.array(bucket[starts].astype(np.int32)),
                        "branch": _branch(branch, len(starts)),
                        "n": pa.array(np.diff(np.append(starts, len(bucket))).astype(np.int64)),
                        **_term_bytes(terms.take(pa.array(order)), starts),
                        "df": _packed(df[order], starts),
                    }
                )
            )
        if parts:
            return pa.concat_tables(parts)
        kinds = {"block": pa.int32(), "bucket": pa.int32(), "branch": pa.string(), "n": pa.int64()}
        kinds |= {"terms": pa.binary(), "sizes": pa.binary(), "df": pa.binary()}
        return pa.table({name: pa.array([], kind) for name, kind in kinds.items()})

    return run


def _of_branch(table: pa.Table, branch: str) -> pa.Table:
    return table.filter(pc.equal(table.column("branch"), branch))


def _summed(min_df: dict[str, int]):
    """Terms of a group of buckets, with their sums that reach ``min_df``."""

    def run(lists: pa.Table) -> pa.Table:
        parts = []
        for branch in pc.unique(lists.column("branch")).to_pylist():
            mine = _of_branch(lists, branch)
            encoded = _unlisted(mine).dictionary_encode()
            df = np.bincount(_codes(encoded), _bytes(mine.column("df"), np.int64), len(encoded.dictionary)).astype(np.int64)
            kept = df >= min_df.get(branch, 0)
            parts.append(
                pa.table(
                    {
                        "branch": _branch(branch, int(kept.sum())),
                        "term": encoded.dictionary.filter(pa.array(kept)).cast(pa.string()),
                        "df": pa.array(df[kept]),
                    }
                )
            )
        return pa.concat_tables(parts)

    return run


def _matched(values: list[str]):
    """For each block and branch: its terms of a group of buckets that are known, and their values."""

    def run(lists: pa.Table, known: pa.Table) -> pa.Table:
        parts = []
        for branch in pc.unique(lists.column("branch")).to_pylist():
            mine, listed = _of_branch(lists, branch).sort_by("block"), _of_branch(known, branch)
            if not len(listed):
                continue
            terms, value_set = _unlisted(mine), listed.column("term").cast(pa.large_string()).combine_chunks()
            place = pc.fill_null(pc.index_in(terms, value_set=value_set), -1).to_numpy().astype(np.int64)
            blocks = np.repeat(mine.column("block").to_numpy(), mine.column("n").to_numpy())
            there = place >= 0
            terms, place, blocks = terms.filter(pa.array(there)), pa.array(place[there]), blocks[there]
            starts = _starts(blocks)
            offsets = pa.array(np.append(starts, len(blocks)), pa.int32())
            parts.append(
                pa.table(
                    {
                        "block": pa.array(blocks[starts], pa.int32()),
                        "branch": _branch(branch, len(starts)),
                        **_term_bytes(terms, starts),
                        **{v: pa.ListArray.from_arrays(offsets, listed.column(v).combine_chunks().take(place)) for v in values},
                    }
                )
            )
        if parts:
            return pa.concat_tables(parts)
        kinds = {"block": pa.int32(), "branch": pa.string(), "terms": pa.binary(), "sizes": pa.binary()}
        kinds |= {v: pa.list_(known.schema.field(v).type) for v in values}
        return pa.table({name: pa.array([], kind) for name, kind in kinds.items()})

    return run


# --- over all blocks -------------------------------------------------------------


def _texts(docs: DataFrame, ranges: dict[str, tuple[int, int]], text_col: str, *more: str) -> DataFrame:
    made = {WORD: lambda t: F.array_join(word_tokens(t), " "), CHAR: char_words}
    return docs.select(*more, *[made[branch](F.col(text_col)).alias(branch) for branch in ranges])


def block_terms(
    docs: DataFrame,
    ranges: dict[str, tuple[int, int]],
    text_col: str = "clean_text",
    doc_col: str = "row_idx",
    chars: int | None = None,
) -> BlockTerms:
    """The terms of ``docs``; ``ranges`` maps a branch to its n-gram sizes.

    ``chars`` are the characters of all texts, about, if they are known: the documents are then
    dealt to their blocks once and stored there, so that their texts are shuffled only once.
    """
    block = lambda blocks: F.pmod(F.xxhash64(doc_col), F.lit(blocks)).cast("int").alias("block")
    if chars is None:
        texts = materialize(_texts(docs, ranges, text_col, doc_col))
        chars = texts.agg(F.sum(sum((F.coalesce(F.length(b), F.lit(0)) for b in ranges), F.lit(0)))).first()[0]
        dealt = texts.select("*", block(max(1, -(-(chars or 0) // BLOCK_CHARS))))
    else:
        rows = docs.select(doc_col, F.col(text_col), block(max(1, -(-chars * len(ranges) // BLOCK_CHARS))))
        dealt = store_bucketed(rows, ["block"], then=lambda df: _texts(df, ranges, text_col, doc_col, "block"))
    counted = dealt.groupBy("block").applyInArrow(_counted(ranges), f"block int, {LISTS}")
    return BlockTerms(dealt, materialize(counted), ranges, doc_col)


def _group(lists: DataFrame, more: int = 0) -> Column:
    """The group of a bucket; buckets of ``lists``, or of ``more`` rows, are put together up to ``GROUP`` terms."""
    terms = max(lists.agg(F.sum("n")).first()[0] or 0, more)
    return F.pmod("bucket", F.lit(max(1, min(BUCKETS, -(-terms // GROUP))))).alias("group")


def summed_lists(lists: DataFrame, min_df: dict[str, int] | None = None) -> DataFrame:
    """``(branch, term, df)`` of all terms of written ``lists``, or of those that reach ``min_df``."""
    grouped = lists.select(_group(lists), "branch", "terms", "sizes", "df")
    return grouped.groupBy("group").applyInArrow(_summed(min_df or {}), "branch string, term string, df bigint")


def term_occurrences(docs: DataFrame, ranges: dict[str, tuple[int, int]], text_col: str = "clean_text") -> DataFrame:
    """``(branch, term, n)``: how often each term occurs over all documents."""
    return summed_lists(counted_terms(docs, ranges, text_col, occurrences=True)).withColumnRenamed("df", "n")


def counted_terms(
    docs: DataFrame, ranges: dict[str, tuple[int, int]], text_col: str = "clean_text", occurrences: bool = False
) -> DataFrame:
    """Written lists of terms: in how many of some documents read together each of their terms occurs,
    or with ``occurrences`` how often. `summed_lists` sums them."""
    count = _counted(ranges, occurrences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            # a batch of long texts is cut into parts
            chars = sum(
                np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
                for column in batch.columns
            )
            start = 0
            while start < len(batch):
                before = int(chars[start - 1]) if start else 0
                stop = int(np.searchsorted(chars, before + BLOCK_CHARS - size, "right"))
                stop = min(max(stop, start + 1), len(batch))
                held.append(batch.slice(start, stop - start))
                size += int(chars[stop - 1]) - before
                start = stop
                if size >= BLOCK_CHARS or start < len(batch):
                    yield from told(held)
                    held, size = [], 0
        if held:
            yield from told(held)

    def told(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        table = table.append_column("block", pa.array(np.zeros(len(table), np.int32)))
        return count(table).drop_columns(["block"]).to_batches(max_chunksize=BATCH)

    return materialize(_texts(docs, ranges, text_col).mapInArrow(run, LISTS))


def _weighed(ranges: dict[str, tuple[int, int]], doc_col: str, values: list[str]):
    """For each branch: documents' rows, terms, counts, values and ``x`` of the known terms."""

    def run(docs: pa.Table, known: pa.Table):
        if not len(docs) or not len(known):
            return
        for branch, at, numbers, tf, terms in _found(docs, ranges):
            mine = _of_branch(known, branch)
            place = pc.fill_null(pc.index_in(terms, value_set=_unlisted(mine)), -1).to_numpy().astype(np.int64)
            there = place[numbers] >= 0
            at, numbers, tf = at[there], numbers[there], tf[there]
            given = {v: pc.list_flatten(mine.column(v)).combine_chunks() for v in values}
            x = (np.log(tf) + 1.0) * given["idf"].to_numpy(zero_copy_only=False)[place[numbers]]
            yield branch, at, numbers, tf, terms, {v: a.take(pa.array(place[numbers])) for v, a in given.items()}, x

    return run


def _same(docs: pa.Table, doc_col: str) -> pa.DictionaryArray:
    """IDs as numbers; null is one of them."""
    return docs.column(doc_col).combine_chunks().dictionary_encode(null_encoding="encode")


def _asked(blocks: BlockTerms, vocab: DataFrame):
    """Each block's documents beside those of its terms that ``vocab`` knows."""
    values = [c for c in vocab.columns if c not in ("branch", "term")]
    kinds = ", ".join(f"`{v}` array<{vocab.schema[v].dataType.simpleString()}>" for v in values)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = _bucket(batch.column("term").cast(pa.large_string()))
            yield batch.append_column("bucket", pa.array(bucket.astype(np.int32)))

    known = vocab.select("branch", "term", *values).filter("branch IS NOT NULL AND term IS NOT NULL")
    group = _group(blocks.lists, known.count())
    known = known.mapInArrow(placed, StructType([*known.schema.fields, StructField("bucket", IntegerType())]))
    lists = blocks.lists.select(group, "block", "branch", "n", "terms", "sizes")
    asked = (
        lists.groupBy("group")
        .cogroup(known.select(group, "branch", "term", *values).groupBy("group"))
        .applyInArrow(_matched(values), f"block int, branch string, terms binary, sizes binary, {kinds}")
    )
    return blocks.docs.groupBy("block").cogroup(asked.groupBy("block"))


def weigh_blocks(blocks: BlockTerms, vocab: DataFrame, sort: bool = False) -> DataFrame:
    """``(doc, branch, term, tf, ..., x, weight)``: ``x`` over its length by document and branch is ``weight``.

    With ``sort`` a document's rows come in the order of their terms, so sums over them are always the same.
    """
    values = [c for c in vocab.columns if c not in ("branch", "term", "weight")]
    doc_col, weighed = blocks.doc_col, _weighed(blocks.ranges, blocks.doc_col, values)
    kinds = {f.name: f.dataType.simpleString() for f in vocab.schema}
    doc_kind = blocks.docs.schema[doc_col].dataType.simpleString()
    schema = (
        f"`{doc_col}` {doc_kind}, branch string, term string, tf int, "
        + ", ".join(f"`{v}` {kinds[v]}" for v in values)
        + ", x double, weight double"
    )
    names = [doc_col, "branch", "term", "tf", *values, "x", "weight"]

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        parts, ids = [], docs.column(doc_col).combine_chunks()
        same = _same(docs, doc_col).indices.to_numpy() if len(docs) else None
        for branch, at, numbers, tf, terms, given, x in weighed(docs, known):
            if sort:
                rank = np.empty(len(terms), np.int64)
                rank[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
                order = np.lexsort((rank[numbers], at))
                at, numbers, tf, x = at[order], numbers[order], tf[order], x[order]
                given = {v: column.take(pa.array(order)) for v, column in given.items()}
            length = np.sqrt(np.bincount(same[at], x * x))
            for a in range(0, len(at), BATCH):
                cut = slice(a, a + BATCH)
                parts.append(
                    pa.record_batch(
                        [
                            ids.take(pa.array(at[cut])),
                            _branch(branch, len(at[cut])),
                            terms.take(pa.array(numbers[cut])).cast(pa.string()),
                            pa.array(tf[cut], pa.int32()),
                            *[given[v][a : a + BATCH] for v in values],
                            pa.array(x[cut]),
                            pa.array(x[cut] / length[same[at[cut]]]),
                        ],
                        names=names,
                    )
                )
        if parts:
            return pa.Table.from_batches(parts)
        empty = {"branch": pa.string(), "term": pa.string(), "tf": pa.int32(), "x": pa.float64(), "weight": pa.float64()}
        empty |= {doc_col: ids.type} | {v: known.schema.field(v).type.value_type for v in values}
        return pa.table({n: pa.array([], empty[n]) for n in names})

    return _asked(blocks, vocab.select("branch", "term", *values)).applyInArrow(run, schema)


def sum_blocks(blocks: BlockTerms, model: DataFrame, branches: tuple[str, ...]) -> DataFrame:
    """``(doc, dot_<branch>, square_<branch>)`` of the documents with a term of ``model``."""
    doc_col, weighed = blocks.doc_col, _weighed(blocks.ranges, blocks.doc_col, ["idf", "weight"])
    names = [f"{name}_{branch}" for branch in branches for name in ("dot", "square")]
    schema = f"`{doc_col}` {blocks.docs.schema[doc_col].dataType.simpleString()}, " + ", ".join(
        f"{n} double" for n in names
    )

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        same = _same(docs, doc_col)
        numbers, n = same.indices.to_numpy(), len(same.dictionary)
        sums, seen = {name: np.zeros(n) for name in names}, np.zeros(n, bool)
        for branch, at, _, _, _, given, x in weighed(docs, known):
            seen[numbers[at]] = True
            if branch in branches:
                weight = given["weight"].to_numpy(zero_copy_only=False)
                sums[f"dot_{branch}"] = np.bincount(numbers[at], x * weight, n)
                sums[f"square_{branch}"] = np.bincount(numbers[at], x * x, n)
        table = pa.table({doc_col: same.dictionary} | {name: pa.array(sums[name]) for name in names})
        return table.filter(pa.array(seen))

    return _asked(blocks, model.select("branch", "term", "idf", "weight")).applyInArrow(run, schema)


def block_entries(blocks: BlockTerms, vocab: DataFrame, packed: bool = False) -> DataFrame:
    """``(doc, idx, value)``: one row for each ID with a known term, its features' numbers in order and their
    weights of unit length by branch. ``vocab`` numbers the terms (``idx``). With ``packed`` both are the
    bytes of their 64-bit numbers, so that rows move as they are."""
    doc_col, weighed = blocks.doc_col, _weighed(blocks.ranges, blocks.doc_col, ["idf", "idx"])
    kinds = ("binary", "binary") if packed else ("array<bigint>", "array<double>")
    schema = f"`{doc_col}` {blocks.docs.schema[doc_col].dataType.simpleString()}, idx {kinds[0]}, value {kinds[1]}"
    # Spark's logarithms, which may differ from numpy's in the last bit; counts beyond them are rare
    known_logs = blocks.docs.sparkSession.range(1, LOGS).select(F.log("id")).collect()
    logs = np.array([0.0, *[row[0] for row in known_logs]])

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        same = _same(docs, doc_col)
        numbers, n = same.indices.to_numpy(), len(same.dictionary)
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for _, at, found, tf, terms, given, _ in weighed(docs, known):
            # sums in the order of terms, so that they are always the same
            rank = np.empty(len(terms), np.int64)
            rank[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
            order = np.lexsort((rank[found], at))
            own, idx, tf = numbers[at][order].astype(np.int64), given["idx"].to_numpy()[order], tf[order].astype(np.int64)
            log = np.where(tf < LOGS, logs[np.minimum(tf, LOGS - 1)], np.log(tf))
            x = (log + 1.0) * given["idf"].to_numpy()[order]
            parts.append((own, idx, x / np.sqrt(np.bincount(own, x * x, n))[own]))
        own, idx, value = (np.concatenate(column) for column in zip(*parts))
        order = np.lexsort((value, idx, own))
        sizes = np.bincount(own, minlength=n)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        if packed:
            lists = [_packed(column[order], starts[:-1]) for column in (idx, value)]
        else:
            offsets = pa.array(starts, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(column[order])) for column in (idx, value)]
        return pa.table({doc_col: same.dictionary, "idx": lists[0], "value": lists[1]}).filter(pa.array(sizes > 0))

    return _asked(blocks, vocab.select("branch", "term", "idf", "idx")).applyInArrow(run, schema)
