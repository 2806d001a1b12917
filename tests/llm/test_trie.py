import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lexisieve.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, part int, words int, n_convs int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in rows], SCHEMA)


def of(rows):
    """``conv -> [(role, text)]``; equal numbers go by role, then digest."""
    held = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            id = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            held.setdefault(conv, []).append((turn is not None, turn or 0, role, id, text))
    return {conv: [(t[2], t[4]) for t in sorted(turns)] for conv, turns in held.items()}


def rebuilt(held):
    out = {}
    for conv, turns in held.items():
        h = zlib.crc32(str(conv).encode()) % 4
        out[conv] = held.get(conv - conv % 20, [])[:h] + turns[h:]
    return out


def brute(held):
    """Nodes by going through all starts of all conversations."""
    members, ends = {}, {}
    for conv, turns in held.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
        ends.setdefault(tuple(turns), []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    rows = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode().split()) for m in below if m)
        rows.append(
            (
                min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                len(children.get(node, [])), sum(m not in children for m in below), saved,
                hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
            )
        )
    return sorted(rows, key=str)


def found(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def some_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 2, 3, 5, 8])):
            # a third of all conversations begins with one turn, and many go on alike
            text = "hot start" if turn == 0 and conv % 3 == 0 else f"text {rng.randrange(3)} of words"
            rows.append((conv, turn, rng.choice(["user", "assistant"]) if turn else "user", text))
    return rows


@pytest.mark.parametrize("block", [1, 700, 1 << 20])
def test_nodes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(trie, "BLOCK_BYTES", block)
    rows = some_rows(150, block)
    gathered = trie.gather_turns(conversations(spark, rows))
    assert found(trie.prefix_nodes(gathered)) == brute(of(rows))
    assert found(trie.prefix_nodes(trie.shared_starts(gathered))) == brute(rebuilt(of(rows)))


def test_nulls_ties_repeated_rows_and_long_texts(spark):
    long = "word one \t" * 30_000
    rows = [
        (20, 0, "user", "a"), (20, 0, "user", "a"), (20, None, None, None), (21, 5, "user", long), (21, 5, "bot", "x"),
        (22, 1, "user", ""), (-7, 0, "user", "a"), (45, 3, "b", "late"), (45, 3, "b", "early"), (None, 0, "user", "lost"),
        (63, 0, "user", long), (63, 1, "user", "\x1c  "),
    ]
    gathered = trie.gather_turns(conversations(spark, rows))
    assert found(trie.prefix_nodes(gathered)) == brute(of(rows))
    held = of(rows)
    own = {c: (held.get(c - c % 20 if c >= 0 else c + -c % 20, []), t) for c, t in held.items()}
    want = {c: base[: zlib.crc32(str(c).encode()) % 4] + t[zlib.crc32(str(c).encode()) % 4 :] for c, (base, t) in own.items()}
    assert found(trie.prefix_nodes(trie.shared_starts(gathered))) == brute(want)


def test_many_equal_conversations(spark):
    """More members end at one node than a chunk holds."""
    many = spark.range(5000).select(
        (F.col("id") * 3).alias("conv_id"), F.lit(0).cast("bigint").alias("turn"),
        F.lit("user").alias("role"), F.lit("the same").alias("text"),
    )
    rows = [(3 * i, 0, "user", "the same") for i in range(5000)]
    assert found(trie.prefix_nodes(trie.gather_turns(many))) == brute(of(rows))


def test_turnless_conversations_are_members_of_the_root(spark):
    gathered = trie.gather_turns(conversations(spark, [(1, 0, "user", "a"), (2, 0, "user", "b")]))
    none = gathered.withColumn("turns", F.when(F.col("conv_id") == 1, F.slice("turns", 1, 0)).otherwise(F.col("turns")))
    assert found(trie.prefix_nodes(none)) == brute({1: [], 2: [("user", "b")]})


def test_empty_table(spark):
    assert trie.prefix_nodes(trie.shared_starts(trie.gather_turns(conversations(spark, [])))).count() == 0


def test_radix_tree_grows_and_keeps_order():
    rng = random.Random(5)
    keys = {bytes(rng.choices(range(rng.choice([2, 40, 256])), k=rng.randrange(12))) for _ in range(4000)}
    tree, layouts, read = trie.RadixTree(), set(), []
    for key in rng.sample(sorted(keys), len(keys)):
        tree.insert(key, key)
    steps = [(b"", tree.root)]
    while steps:
        before, node = steps.pop()
        before += node.path
        layouts.add(node.capacity)
        if node.value is not None:
            assert node.value == before
            read.append(before)
        steps += [(before + bytes([b]), child) for b, child in reversed(list(node.items()))]
    assert read == sorted(keys) and layouts == {4, 16, 48, 256}
