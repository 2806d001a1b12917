"""Sharding: contiguous shards of ordered groups with the smallest possible largest shard.

Groups are all rows of equal text and are never cut. They stand in the order of their
text's SHA-256. A shard holds groups up to a capacity, or one group that is larger. The
smallest capacity for which greedy filling needs no more than the given number of shards is
found by binary search; the cuts are where the greedy filling under that capacity makes
them. As a group larger than the capacity stands alone, it does not raise what the other
shards may hold; no way of cutting has a smaller largest shard. Where greedy filling leaves
shards over, the largest shards of several groups are halved until none is empty.

No list of groups reaches the driver. It holds a partition of the digest space into
ranges with their byte sums, at first 4096 of them. Filling is simulated on ranges, so a
cut is known to lie within some range; ranges in which cuts fall are split by the next
digest digits (one aggregation over the groups of just those ranges) until every cut the
search depends on falls between two groups. Sums give a capacity that is surely enough and
one that is surely too small; 16 capacities between them are looked at more closely at a
time, so a round splits at most 33 ranges per shard, into at most 256 parts each.

Native: DataFrame functions only; the driver does arithmetic on range sums.

Defined results: null text counts as a group of its own, apart from empty text; empty
tables give an empty result; repeated rows are rows of the same group, and equal ones are
numbered together; with fewer groups than shards some shards are empty; other columns are
not looked at.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexisieve.session import materialize

FIRST_DIGITS, MORE_DIGITS, NULL_DIGEST = 3, 2, "~"
SLOT_BUCKETS, ROW_BYTES, PROBES = 1024, 8, 15


def text_digest(text: Column) -> Column:
    """The group key: hexadecimal SHA-256, and ``~`` (after every digest) for null."""
    return F.coalesce(F.sha2(text.cast("binary"), 256), F.lit(NULL_DIGEST))


@dataclass
class Range:
    """All groups whose digest starts with ``prefix``; ``largest`` is the largest group."""

    prefix: str
    total: int
    largest: int
    groups: int


def _ranges(groups: DataFrame, digits: int) -> list[Range]:
    rows = (
        groups.groupBy(F.substring("digest", 1, digits).alias("prefix"))
        .agg(F.sum("total").alias("total"), F.max("total").alias("largest"), F.count("*").alias("groups"))
        .collect()
    )
    return sorted((Range(r.prefix, r.total, r.largest, r.groups) for r in rows), key=lambda r: r.prefix)


def _split(groups: DataFrame, ranges: list[Range], chosen: set[int]) -> list[Range]:
    """``ranges`` with the chosen ones replaced by their parts; one job for each digest length."""
    parts: dict[str, list[Range]] = {ranges[i].prefix: [] for i in chosen}
    for length in sorted({len(p) for p in parts}):
        here = [p for p in parts if len(p) == length]
        inside = groups.filter(F.substring("digest", 1, length).isin(here))
        for part in _ranges(inside, length + MORE_DIGITS):
            parts[part.prefix[:length]].append(part)
    return [x for i, r in enumerate(ranges) for x in (parts[r.prefix] if i in chosen else [r])]


def _ends(ranges: list[Range]) -> list[int]:
    return list(accumulate(r.total for r in ranges))


def _fill(
    ranges: list[Range], ends: list[int], capacity: int, shards: int, hopeful: bool
) -> tuple[bool, list[int], set[int]]:
    """Greedy filling: ``(fits, first range after each cut, ranges to look closer at)``.

    Of a range with several groups that does not fit whole, the careful filling takes
    nothing and the hopeful one as much as there is room for, or all of it with one more
    shard if one of its groups may stand alone. The truth is between them.
    """
    used, filled, cuts, inside = 0, 0, [], set()
    while not ends or filled < ends[-1]:
        used += 1
        i = bisect_right(ends, filled + capacity)
        if used > shards:
            return False, cuts, inside
        if i == len(ranges):
            return True, cuts, inside
        here, start = ranges[i], ends[i - 1] if i else 0
        if here.groups > 1:
            inside.add(i)
            if here.largest > capacity:
                if not hopeful:
                    return False, cuts, inside
                used += start > filled
                filled, i = ends[i], i + 1
            elif hopeful:
                filled += capacity
            elif start <= filled:
                return False, cuts, inside
            else:
                filled = start
        elif start <= filled:  # larger than the capacity: alone
            filled, i = ends[i], i + 1
        else:
            filled = start
        cuts.append(i)
    return used <= shards, cuts[:-1], inside


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """The largest shard's size, and for each cut the digest prefix that starts the next shard.

    ``groups`` is ``(digest, total)``, one row per group.
    """
    ranges = _ranges(groups, FIRST_DIGITS)
    if not ranges:
        return 0, []
    total = sum(r.total for r in ranges)
    too_small, enough = -1, total
    while True:
        ends = _ends(ranges)
        undecided: list[int] = []
        low, high = too_small, enough
        while high - low > 1:  # what is surely enough
            middle = (low + high) // 2
            if _fill(ranges, ends, middle, shards, hopeful=False)[0]:
                high = middle
            else:
                low = middle
        enough, low, high = high, too_small, high
        while high - low > 1:  # what is surely too small
            middle = (low + high) // 2
            if _fill(ranges, ends, middle, shards, hopeful=True)[0]:
                high = middle
            else:
                low = middle
        too_small = low
        if enough - too_small > 1:
            undecided = [too_small + 1 + (enough - 2 - too_small) * k // PROBES for k in range(PROBES + 1)]
        closer = _fill(ranges, ends, enough, shards, hopeful=False)[2]
        for capacity in undecided:
            for hopeful in (False, True):
                closer |= _fill(ranges, ends, capacity, shards, hopeful)[2]
        if not closer:
            cuts = _fill(ranges, ends, enough, shards, hopeful=False)[1]
            return max(enough, *(r.largest for r in ranges)), _no_empty_shard(groups, ranges, cuts, shards)
        ranges = _split(groups, ranges, closer)


def _no_empty_shard(groups: DataFrame, ranges: list[Range], cuts: list[int], shards: int) -> list[str]:
    """Starts of shards after halving the largest ones of several groups while shards are left over."""
    starts = [ranges[i].prefix for i in cuts]
    while len(starts) + 1 < shards:
        edges = [0, *(next(i for i, r in enumerate(ranges) if r.prefix >= s) for s in starts), len(ranges)]
        parts = [(a, b) for a, b in zip(edges, edges[1:]) if sum(r.groups for r in ranges[a:b]) > 1]
        if not parts:
            break
        a, b = max(parts, key=lambda part: sum(r.total for r in ranges[part[0] : part[1]]))
        if b - a == 1:
            ranges = _split(groups, ranges, {a})
            continue
        ends = [0, *_ends(ranges[a:b])]
        middle = min(range(1, b - a), key=lambda i: abs(2 * ends[i] - ends[-1]))
        starts = sorted([*starts, ranges[a + middle].prefix])
    return starts


def shard_documents(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, size, digest, text_crc32, shard, slot`` for every row.

    Slots run from 0 without gaps in each shard. They are counted in buckets by a hash of id
    and text, of which there are a fixed number per shard, so no task numbers a whole shard.
    """
    binary = F.col(text_col).cast("binary")
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(F.coalesce(binary, F.lit(b""))).alias("text_crc32"),
            text_digest(F.col(text_col)).alias("digest"),
        )
    )
    groups = materialize(rows.groupBy("digest").agg(F.sum("size").alias("total")))
    bounds = minimax_cuts(groups, shards)[1]
    shard = sum((F.when(F.col("digest") >= b, 1).otherwise(0) for b in bounds), F.lit(0))
    # rows of one id and text are one here, however many there are
    columns = ("doc_id", "size", "digest", "text_crc32")
    placed = (
        rows.groupBy(*columns)
        .agg(F.count("*").alias("_n"))
        .withColumn("shard", shard)
        .withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SLOT_BUCKETS)))
    )
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "_bucket")
        .agg(F.sum("_n").alias("_n"))
        .select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("shard", "_bucket").orderBy("doc_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_place", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), ["shard", "_bucket"])  # at most shards * SLOT_BUCKETS rows
        .withColumn("_again", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)))
        .select(
            *columns, "shard",
            (F.col("_offset") + F.col("_place") + F.col("_again")).cast("bigint").alias("slot"),
        )
    )
