"""Prefix trie of conversations: adaptive radix trees over fixed-width turn ids.

A turn's id is 16 bytes, the first of the SHA-256 of its role and text. A conversation's
key is the ids of its turns one after the other, each big-endian, so the order of keys is
the order of their ids, and a prefix of whole turns is a prefix of bytes that ends at a
multiple of 16.

Distinct keys are dealt to tasks by ranges and sorted. A task reads its range as a stream
and puts blocks of about ``BLOCK_BYTES`` of keys into adaptive radix trees (`RadixTree`):
inner nodes hold 4, 16, 48 or 256 children and grow when full, and bytes without a branch
are kept as one path. A walk through the tree emits a node at each depth that is a whole
number of turns. A prefix that several blocks hold is emitted by each of them, and Spark
adds the parts up: all columns are sums or minima over keys once a block knows which of its
prefixes the key before it has too. Two keys for each range border are what the driver
sees.

Members that end at a node are digested from chunks of ``CHUNK`` ids in order, so a
conversation that is repeated any number of times is never gathered.

Defined results: null roles and texts are empty; turns are ordered by number (null first),
then role, then digest; repeated rows are turns of their own; rows without conversation id
take no part; texts of any length count whole; an empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisieve.llm.common import SPACES
from lexisieve.operators.skew import join_by_weight
from lexisieve.session import materialize

WIDTH = 16
BLOCK_BYTES = 1 << 20
CHUNK = 1024
ROOT = bytes(WIDTH)


class Node:
    """A node of a radix tree: the bytes before it, a value, and children by byte.

    Up to 16 children: a sorted list of bytes beside the children. Up to 48: a table from
    byte to place. Beyond: one place for each byte.
    """

    __slots__ = ("path", "value", "capacity", "bytes", "children")

    def __init__(self, path: bytes, value=None):
        self.path, self.value = path, value
        self.capacity, self.bytes, self.children = 4, bytearray(), []

    def get(self, byte: int) -> Node | None:
        if self.capacity <= 16:
            at = self.bytes.find(byte)
            return self.children[at] if at >= 0 else None
        if self.capacity == 48:
            at = self.bytes[byte]
            return self.children[at - 1] if at else None
        return self.children[byte]

    def put(self, byte: int, child: Node) -> None:
        """Add a child, or replace the one at ``byte``."""
        if self.capacity <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.children[at] = child
            elif len(self.children) < self.capacity:
                at = sum(b < byte for b in self.bytes)
                self.bytes.insert(at, byte)
                self.children.insert(at, child)
            else:
                self._grow()
                self.put(byte, child)
        elif self.capacity == 48:
            at = self.bytes[byte]
            if at:
                self.children[at - 1] = child
            elif len(self.children) < 48:
                self.children.append(child)
                self.bytes[byte] = len(self.children)
            else:
                self._grow()
                self.put(byte, child)
        else:
            self.children[byte] = child

    def _grow(self) -> None:
        held = list(self.items())
        self.capacity = {4: 16, 16: 48, 48: 256}[self.capacity]
        if self.capacity == 48:
            self.bytes, self.children = bytearray(256), []
        elif self.capacity == 256:
            self.bytes, self.children = bytearray(), [None] * 256
        if self.capacity > 16:
            for byte, child in held:
                self.put(byte, child)

    def items(self) -> Iterator[tuple[int, Node]]:
        """Children by byte, ascending."""
        if self.capacity <= 16:
            yield from zip(self.bytes, self.children)
        elif self.capacity == 48:
            yield from ((b, self.children[at - 1]) for b, at in enumerate(self.bytes) if at)
        else:
            yield from ((b, child) for b, child in enumerate(self.children) if child is not None)


def common_bytes(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class RadixTree:
    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        above, node, at = None, self.root, 0
        while True:
            common = common_bytes(node.path, key[at : at + len(node.path)])
            if common < len(node.path):
                upper = Node(node.path[:common])
                upper.put(node.path[common], node)
                node.path = node.path[common + 1 :]
                if above is None:
                    self.root = upper
                else:
                    above.put(key[at - 1], upper)
                node = upper
            at += common
            if at == len(key):
                node.value = value
                return
            below = node.get(key[at])
            if below is None:
                node.put(key[at], Node(key[at + 1 :], value))
                return
            above, node, at = node, below, at + 1


class _Prefix:
    """A prefix of whole turns while the walk is below it."""

    __slots__ = ("id", "words", "new", "n", "conv", "ends", "children", "leaves", "members", "own")

    def __init__(self, id: bytes, words: int, new: bool):
        self.id, self.words, self.new = id, words, new
        self.n, self.conv, self.ends = 0, None, None
        self.children = self.leaves = self.members = self.own = 0


def block_nodes(
    entries: list[tuple[bytes, list[int], int, int, str]], shared: int, extended: bool
) -> list[tuple]:
    """Parts of all nodes of a block of sorted distinct keys ``(key, words, n, conv, ends)``.

    ``shared`` turns of the first key begin the key before the block too (-1: there is none);
    ``extended`` says whether the key after the block begins with the last one. Rows are
    ``(node, parent, depth, n, conv, children, leaves, members, own, ends)``, where
    ``members`` sums the words of all members from the node on and ``own`` those of the
    distinct prefixes.
    """
    tree, words_of = RadixTree(), {}
    for entry in entries:
        tree.insert(entry[0], entry)
        for turn, words in enumerate(entry[1]):
            words_of[entry[0][turn * WIDTH : (turn + 1) * WIDTH]] = words
    first, last = entries[0][0], entries[-1][0]
    out, above = [], [_Prefix(ROOT, 0, shared < 0)]

    def leave() -> None:
        done = above.pop()
        if not done.children and not (extended and len(out_key) == len(last) and bytes(out_key) == last):
            done.leaves = int(done.new)
        done.members += done.words * done.n
        done.own += done.words * done.new
        up = above[-1] if above else None
        if up is not None:
            up.n += done.n
            up.conv = done.conv if up.conv is None else min(up.conv, done.conv)
            up.children += 1
            up.leaves += done.leaves
            up.members += done.members
            up.own += done.own
        out.append(
            (
                done.id, up and up.id, len(above), done.n, done.conv, done.children, done.leaves,
                done.members, done.own, done.ends, done.new,
            )
        )

    out_key, turn = bytearray(), bytearray()  # of the prefix walked so far; its unfinished turn
    steps = [(0, b"", tree.root)]
    on_first = 0  # turns of the first key that the walk is still on
    while steps:
        kind, edge, node = steps.pop()
        if kind:  # back from a node: its prefixes and bytes go
            for _ in range(len(edge)):
                if len(out_key) % WIDTH == 0:
                    leave()
                out_key.pop()
            continue
        edge += node.path
        for byte in edge:
            out_key.append(byte)
            if len(out_key) % WIDTH == 0:
                turn = bytes(out_key[-WIDTH:])
                depth = len(out_key) // WIDTH
                old = depth <= shared and first.startswith(bytes(out_key))
                id = hashlib.sha256(above[-1].id + turn).digest()[:WIDTH]
                above.append(_Prefix(id, words_of[turn], not old))
        steps.append((1, edge, node))
        if node.value is not None:
            _, _, n, conv, ends = node.value
            here = above[-1]
            here.n, here.conv, here.ends = here.n + n, conv, ends
        steps += [(0, bytes([byte]), child) for byte, child in reversed(list(node.items()))]
    leave()
    # a child that the block before holds too is counted there
    parents_of_old = {row[1] for row in out if not row[10]}
    return [(*row[:5], row[5] - (row[0] in parents_of_old), *row[6:10]) for row in out]


NODES = (
    "node binary, parent binary, depth bigint, n_convs bigint, conv_id bigint, n_children bigint, "
    "n_leaves bigint, members bigint, own bigint, ends_sha256 string"
)


def _blocks(rows: Iterator[tuple], borders: dict[int, tuple[int, bool]]) -> Iterator[list[tuple]]:
    """Nodes block by block; ``rows`` are ``(range, key, words, n, conv, ids)`` in order."""
    block, size, shared, current, digest = [], 0, -1, None, None

    def closed() -> tuple:
        key, words, n, conv = current[1:]
        return key, words, n, conv, digest.hexdigest()

    for part, key, words, n, conv, ids in rows:
        if current is not None and (part, key) == (current[0], current[1]):  # a further chunk
            digest.update(b"," + ids.encode())
            current = (part, key, words, current[3] + n, min(current[4], conv))
            continue
        if current is not None:
            block.append(closed())
            size += len(current[1]) + 200
            if part != current[0] or size >= BLOCK_BYTES:
                ends_here = part != current[0]
                extended = borders[current[0]][1] if ends_here else key.startswith(current[1])
                yield block_nodes(block, shared, extended)
                shared = common_bytes(current[1], key) // WIDTH
                block, size = [], 0
        if current is None or part != current[0]:
            shared = borders[part][0]
        current, digest = (part, key, words, n, conv), hashlib.sha256(ids.encode())
    if current is not None:
        block.append(closed())
        yield block_nodes(block, shared, borders[current[0]][1])


def turn_id(role: Column, text: Column) -> Column:
    """A turn's id as 32 hexadecimal digits; null counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)


def turn_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACES.replace("[", "[^", 1))).cast("bigint")


def gather_turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``(conv_id, turns)``: each conversation's ``(turn, role, id, words)`` in order, without texts."""
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        turn_id(F.col(role_col), F.col(text_col)).alias("id"),
        turn_words(F.col(text_col)).alias("words"),
    )
    return (
        conversations.filter(F.col(conv_col).isNotNull())
        .select(F.col(conv_col).cast("bigint").alias("conv_id"), turn.alias("_turn"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("_turn")).alias("turns"))
    )


def prefix_nodes(gathered: DataFrame) -> DataFrame:
    """Nodes of the trie of ``(conv_id, turns)`` rows, one a conversation.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)``; a node goes by its smallest member.
    """
    chunks = (
        gathered.select(
            "conv_id",
            F.unhex(F.array_join("turns.id", "")).alias("key"),
            F.col("turns.words").alias("words"),
            F.shiftright("conv_id", CHUNK.bit_length() - 1).alias("chunk"),
        )
        .groupBy("key", "chunk")
        .agg(
            F.first("words").alias("words"),
            F.count("*").alias("n"),
            F.min("conv_id").alias("conv"),
            F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
        )
    )
    ranged = materialize(
        chunks.repartitionByRange("key").withColumn("part", F.spark_partition_id().cast("bigint"))
    )
    edges = ranged.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    borders, before = {}, None
    for row in edges.orderBy("part").collect():  # as many rows as there are ranges
        first, last = bytes(row["first"]), bytes(row["last"])
        shared = -1
        if before is not None:
            shared = common_bytes(before[1], first) // WIDTH
            borders[before[0]] = (borders[before[0]][0], first.startswith(before[1]))
        borders[row["part"]] = (shared, False)
        before = (row["part"], last)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
        schema = pa.schema(
            [("node", pa.binary()), ("parent", pa.binary())]
            + [(name.split()[0], pa.int64()) for name in NODES.split(", ")[2:-1]]
            + [("ends_sha256", pa.string())]
        )
        for nodes in _blocks(rows, borders):
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*nodes), schema)], schema=schema)

    parts = (
        ranged.select("part", "key", "words", "n", "conv", "ids", "chunk")
        .repartition("part")
        .sortWithinPartitions("part", "key", "chunk")
        .drop("chunk")
        .mapInArrow(build, NODES)
    )
    nodes = materialize(
        parts.groupBy("node").agg(
            F.min("parent").alias("parent"),
            F.min("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves")],
            (F.sum("members") - F.sum("own")).alias("saved_tokens"),
            F.coalesce(F.max("ends_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
    inner = nodes.filter("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("rows")
    )
    below = join_by_weight(nodes.filter("depth > 0"), inner, ["parent"], "rows", F.col("node"))
    top = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    columns = (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )
    return below.select(*columns).unionByName(top.select(*columns))


def shared_starts(gathered: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations ``c`` rebuilt: the first ``h`` turns of ``c - c % every``, then their own after ``h``.

    ``h`` is the checksum of the decimal id modulo ``most``.
    """
    base = gathered.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_start")
    )
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    none = F.slice("turns", 1, 0)
    return (
        gathered.withColumn("_h", h)
        .withColumn("_of", F.col("conv_id") - F.col("conv_id") % every)
        .join(base, F.col("_of") == F.col("_base"), "left")
        .select(
            "conv_id",
            F.concat(
                F.when(F.col("_h") > 0, F.slice(F.coalesce("_start", none), F.lit(1), F.col("_h"))).otherwise(none),
                F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0))),
            ).alias("turns"),
        )
    )
