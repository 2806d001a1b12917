import hashlib
import random
import zlib

from pyspark.sql import functions as F

from lexisieve.llm import sharding


def smallest_capacity(sizes, shards):
    def fits(capacity):
        used, filled = 1, 0
        for s in sizes:
            if s > capacity:
                return False
            if filled + s > capacity:
                used, filled = used + 1, 0
            filled += s
        return used <= shards

    low, high = max(sizes) - 1, sum(sizes)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    return high


def spread_capacity(totals, shards):
    """The least capacity if larger groups stand alone, by trying all group sums."""
    sizes = [totals[k] for k in sorted(totals)]

    def used(capacity):
        n, filled = 0, None
        for size in sizes:
            if size > capacity:
                n, filled = n + 1, None
            elif filled is None or filled + size > capacity:
                n, filled = n + 1, size
            else:
                filled += size
        return n

    low, high = -1, sum(sizes)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if used(middle) <= shards else (middle, high)
    return high


def check(rows, texts, shards):
    totals = {}
    for text in texts:
        key = "~" if text is None else hashlib.sha256(text.encode()).hexdigest()
        totals[key] = totals.get(key, 0) + len((text or "").encode()) + 8
    loads, slots = {}, {}
    for r in rows:
        loads[r.shard] = loads.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode())
    assert max(loads.values()) == smallest_capacity([totals[k] for k in sorted(totals)], shards)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r.digest, r.shard) for r in rows}) == len(totals) and max(loads) < shards
    assert len(rows) == len(texts)
    # no shard is empty while groups remain
    assert len(loads) == min(shards, len(totals))
    # what the largest group does not force is spread as evenly as contiguous cuts allow
    spread = spread_capacity(totals, shards)
    held = {s: {r.digest for r in rows if r.shard == s} for s in loads}
    assert all(load <= spread or len(held[s]) == 1 for s, load in loads.items())


def test_capacity_is_the_smallest(make_docs):
    rng = random.Random(1)
    texts = [None, "", "é" * 50, *("x" * rng.randint(0, 300) for _ in range(400))]
    texts += ["hot text " * 5] * 200 + [f"{i}" * rng.randint(1, 400) for i in range(300)]
    docs = make_docs(texts)
    for shards in (1, 5, 24):
        check(sharding.shard_documents(docs, shards).collect(), texts, shards)


def test_ranges_are_split_until_cuts_are_exact(make_docs, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_DIGITS", 1)
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    monkeypatch.setattr(sharding, "PROBES", 3)
    rng = random.Random(2)
    texts = [f"{i} " * rng.randint(1, 60) for i in range(700)]
    check(sharding.shard_documents(make_docs(texts), 7).collect(), texts, 7)


def test_few_groups_and_none(make_docs):
    texts = ["a", "b" * 1000, "a"]
    check(sharding.shard_documents(make_docs(texts), 24).collect(), texts, 24)
    assert sharding.shard_documents(make_docs([]), 24).count() == 0


def test_a_hot_group_leaves_no_shard_empty(make_docs):
    """One text in an eighth of all rows sets the largest shard, not the others."""
    rng = random.Random(7)
    texts = ["the hot text of many words " * 4] * 400 + [f"{i} " + "x" * rng.randint(1, 90) for i in range(2600)]
    rows = sharding.shard_documents(make_docs(texts), 24).collect()
    check(rows, texts, 24)
    loads = [sum(r.size for r in rows if r.shard == s) for s in range(24)]
    others = sorted(loads)[:-1]
    assert others[0] > 0 and others[-1] < 2 * sum(others) / len(others)


def test_rows_without_id_and_equal_rows_are_numbered_apart(spark, make_docs):
    docs = make_docs(["a", "b", "c"])
    docs = docs.union(docs).union(docs.withColumn("doc_id", F.lit(None).cast("bigint")))
    rows = sharding.shard_documents(docs, 2).collect()
    assert len(rows) == 9 and sum(r.doc_id is None for r in rows) == 3
    for shard in (0, 1):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
