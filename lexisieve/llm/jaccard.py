"""N-gram Jaccard join: exact links and classes of texts by their word shingles.

Two texts link when their sets of 5-word shingles have a Jaccard similarity of at least
80 percent. Equal sets are one set from the start, found by a digest.

Filtering by several global token orders. If two sets link, then under *any* order of all
tokens their prefixes of ``n - ceil(0.8 n) + 1`` tokens share one. All orders used here
put a hash sample of the tokens first (3/8 of the hash space), of which it is known by a
shuffle who holds them: tokens of a single set first of all, then the others by how often
they occur, last those that at least 1 in 1000 texts hold. A set whose prefix is used up
by tokens of its own has no partner and is done with. The orders differ in how they sort
the shared tokens: by count and hash, by the count's magnitude and another hash, by a
third hash alone. Candidates must share a prefix token under each of them before their
sets are intersected.

Links without all pairs:

1. Each set is compared with one representative of each of its prefix tokens; found links
   give classes.
2. Tokens of up to 64 sets: pairs of different classes are compared.
3. Tokens of more sets: sets that such tokens connect form a cluster. Sets outside the
   cluster's largest class are compared with all of the cluster, block against block of
   256 sets, inside tasks that return only links found.

Nothing is capped: every pair that shares a prefix token is either in one class already or
compared.

Defined results: null, empty and wordless texts have an empty set and link with nothing;
a text of fewer than five words is one shingle; repeated rows link by equal sets; an
empty table gives an empty result; other columns are not looked at. Shingles are 64-bit
hashes and sets are known by a 64-bit digest; at 10^9 sets the chance that any two
digests agree is about 3 percent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexisieve.llm.common import free_memory
from lexisieve.llm.components import connected_components, with_row
from lexisieve.operators.skew import join_by_weight
from lexisieve.session import materialize

WORDS, PERCENT = 5, 80
SAMPLE_EIGHTHS, HOT_SHARE = 3, 1 / 1000
SMALL_LIST, BLOCK = 64, 256
MOST_WORDS, CHUNK = 100_000, 1000
SMALL_BROADCAST = 500_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``text``."""
    # bytes.lower and bytes.split treat exactly A-Z and \x20, \x09-\x0D
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    mixed = np.full(len(parts) - width + 1, width, np.uint64)
    for k in range(width):
        mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[k : k + len(mixed)]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def set_digest(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-n * percent // 100) + 1


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.uint64).view(np.int64)))


def sample_tokens(
    docs: DataFrame, id_col: str, text_col: str, words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``(doc_id, n, s, sampled, rest, counts)`` per text: set size, digest, sampled tokens, and
    the first of the others where the sample is shorter than the prefix.

    Rows without ``n`` hold tokens that are frequent in some run of texts, and their counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        border = np.uint64(SAMPLE_EIGHTHS << 61)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                sizes, digests, sampled, rest = [], [], [], []
                for text in part.column(1).to_pylist():
                    tokens = shingle_set(text, words)
                    cut = int(np.searchsorted(tokens, border))
                    sizes.append(len(tokens))
                    digests.append(set_digest(tokens))
                    sampled.append(tokens[:cut])
                    missing = prefix_length(len(tokens), percent) - cut if len(tokens) else 0
                    rest.append(tokens[cut : cut + max(missing, 0)])
                empty = [np.empty(0, np.uint64)] * len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()), pa.array(sizes, pa.int32()), pa.array(digests, pa.int64()),
                        _lists(sampled), _lists(rest), _lists(empty),
                    ],
                    names,
                )
                first = np.unique(digests, return_index=True)[1]
                tokens, counts = np.unique(
                    np.concatenate([sampled[i] for i in first]), return_counts=True
                )
                often = counts >= max(2, HOT_SHARE / 2 * len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()),
                        _lists([tokens[often]]), _lists(empty[:1]), _lists([counts[often]]),
                    ],
                    names,
                )
        _HASHES.clear()
        batch = part = None
        free_memory()

    names = ["doc_id", "n", "s", "sampled", "rest", "counts"]
    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(
        run,
        "doc_id bigint, n int, s bigint, sampled array<bigint>, rest array<bigint>, counts array<bigint>",
    )


def hot_tokens(sampled: DataFrame, n_texts: int) -> DataFrame:
    """Tokens counted in at least half of 1 in 1000 texts.

    There are at most 2000 times as many of them as an average text has tokens.
    """
    return (
        sampled.filter("n IS NULL")
        .select(F.inline(F.arrays_zip("sampled", "counts")))
        .groupBy(F.col("sampled").alias("token"))
        .agg(F.sum("counts").alias("count"))
        .filter(F.col("count") >= max(2.0, n_texts * HOT_SHARE / 2))
        .select("token")
    )


def _needed(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100).cast("int")


def prefixes(sampled: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(s, n, doc_id, first, second, third)`` of the sets that may have partners.

    ``doc_id`` is the least one of the set, ``first`` to ``third`` the shared prefix tokens
    under the three orders.
    """
    texts = sampled.filter("n > 0")
    hot = materialize(hot_tokens(sampled, texts.count()))
    held = (
        texts.select("s", F.explode("sampled").alias("token"))
        .join(F.broadcast(hot.withColumn("hot", F.lit(True))), "token", "left")  # bounded, see there
        # a hot token's rows are spread by their sets: it is known to be shared
        .withColumn("spread", F.when(F.col("hot"), F.col("s")))
    )
    holders = Window.partitionBy("token", "spread")
    shared = (
        held.withColumn("least", F.min("s").over(holders))
        .withColumn("most", F.max("s").over(holders))
        .withColumn("f", F.count("*").over(holders))
        .filter("hot OR least != most")
        .groupBy("s")
        .agg(
            F.collect_set(F.when(F.col("hot").isNull(), F.struct("f", "token"))).alias("known"),
            F.collect_set(F.when(F.col("hot"), F.col("token"))).alias("hot"),
        )
    )
    sets = texts.groupBy("s").agg(
        F.min("doc_id").alias("doc_id"),
        F.first("n").alias("n"),
        F.first(F.size("sampled")).alias("n_sampled"),
        F.first("rest").alias("rest"),
    )
    none = F.array().cast("array<bigint>")
    known = F.coalesce("known", F.array().cast("array<struct<f:bigint,token:bigint>>"))
    joined = sets.join(shared, "s", "left").select(
        "s", "n", "doc_id", "n_sampled", "rest", known.alias("known"), F.coalesce("hot", none).alias("hot"),
    )
    own = F.col("n_sampled") - F.size("known") - F.size("hot")
    room = F.col("n") - _needed(F.col("n"), percent) + 1 - own
    late = F.concat(F.sort_array("hot"), "rest")

    def prefix(key) -> Column:
        ordered = F.transform(F.sort_array(F.transform("known", key)), lambda x: x["token"])
        return F.slice(F.concat(ordered, late), 1, F.col("room"))

    token = lambda x: x["token"].alias("token")
    return (
        joined.withColumn("room", room)
        .filter((F.col("room") > 0) & (F.size("known") + F.size("hot") + F.size("rest") > 0))
        .select(
            "s",
            "n",
            "doc_id",
            prefix(lambda x: F.struct(x["f"].alias("f"), token(x))).alias("first"),
            prefix(
                lambda x: F.struct(F.floor(F.log2(x["f"])).alias("f"), F.xxhash64(x["token"]).alias("h"), token(x))
            ).alias("second"),
            prefix(lambda x: F.struct(F.xxhash64(x["token"], F.lit(3)).alias("h"), token(x))).alias("third"),
        )
    )


def token_sets(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """``(s, tokens)`` of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                sets = [shingle_set(t, words) for t in batch.column(0).slice(at, CHUNK).to_pylist()]
                digests = pa.array([set_digest(x) for x in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([digests, _lists(sets)], ["s", "tokens"])
        _HASHES.clear()
        batch = None
        free_memory()

    return docs.select(text_col).mapInArrow(run, "s bigint, tokens array<bigint>")


def _linked(inter: Column, a: Column, b: Column, percent: int) -> Column:
    return inter * 100 >= (a + b - inter) * percent


def verify(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the distinct ``pairs(a, b)`` that pass all filters and link.

    ``sets`` is ``(s, n, second, third, tokens)``. Lengths and the other orders come before
    the tokens, which are joined for what they leave.
    """
    heads = sets.select("s", "n", "second", "third")

    def side(table: DataFrame, name: str) -> DataFrame:
        return table.select(*[F.col(c).alias(name if c == "s" else f"{c}_{name}") for c in table.columns])

    candidates = (
        pairs.join(side(heads, "a"), "a")
        .join(side(heads, "b"), "b")
        .filter(
            (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
            & F.arrays_overlap("second_a", "second_b")
            & F.arrays_overlap("third_a", "third_b")
        )
        .select("a", "b")
    )
    tokens = sets.select("s", "tokens")
    both = materialize(candidates).join(side(tokens, "a"), "a").join(side(tokens, "b"), "b")
    inter = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return both.filter(_linked(inter, F.size("tokens_a"), F.size("tokens_b"), percent)).select("a", "b")


def _block_links(percent: int):
    """Links between the left and right sets of one pair of blocks, at most one per left set and class."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["left"]], rows[~rows["left"]]
        out: list[tuple[int, int]] = []
        if len(left) and len(right):
            sizes = right["tokens"].map(len).to_numpy()
            tokens = np.concatenate(right["tokens"].to_list())
            owner = np.repeat(np.arange(len(right)), sizes)
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            ids, classes = right["s"].to_numpy(), right["class"].to_numpy()
            for s, own_class, mine in zip(left["s"], left["class"], left["tokens"]):
                low = np.searchsorted(tokens, mine, "left")
                count = np.searchsorted(tokens, mine, "right") - low
                at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
                inter = np.bincount(owner[at], minlength=len(right))
                hit = (inter * 100 >= (len(mine) + sizes - inter) * percent) & (classes != own_class)
                if hit.any():
                    chosen = np.unique(classes[hit], return_index=True)[1]
                    out += [(s, b) for b in ids[hit][chosen]]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _classes(sets: DataFrame, links: DataFrame) -> DataFrame:
    """``(s, class)`` of every set; a class is its least set."""
    roots = connected_components(links)
    return sets.select("s").join(roots.withColumnRenamed("id", "s"), "s", "left").select(
        "s", F.coalesce("root", "s").alias("class")
    )


def set_links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the sets that all links connect."""
    postings = materialize(sets.select("s", F.explode("first").alias("token")))
    lists = materialize(
        postings.groupBy("token").agg(F.count("*").alias("k"), F.min("s").alias("rep")).filter("k > 1")
    )
    # 1. against one representative of each token
    with_rep = join_by_weight(postings, lists, ["token"], "k", F.col("s"))
    starred = materialize(
        with_rep.filter("s != rep").select(F.col("rep").alias("a"), F.col("s").alias("b")).distinct()
    )
    links = materialize(verify(starred, sets, percent))
    classes = materialize(_classes(sets, links))
    # tokens that still hold several classes
    held = postings.join(classes, "s")
    all_lists = materialize(
        held.groupBy("token")
        .agg(F.count("*").alias("k"), F.min("s").alias("rep"), F.min("class").alias("c1"), F.max("class").alias("c2"))
        .filter("k > 1")
        .select("token", "k", "rep", (F.col("c1") != F.col("c2")).alias("open"))
    )
    open_lists = all_lists.filter("open")
    # 2. short lists: pairs of different classes
    short = materialize(held.join(open_lists.filter(F.col("k") <= SMALL_LIST).select("token"), "token"))
    one = short.select("token", F.col("s").alias("a"), F.col("class").alias("ca"))
    two = short.select("token", F.col("s").alias("b"), F.col("class").alias("cb"))
    pairs = one.join(
        two, (one["token"] == two["token"]) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
    ).select("a", "b")
    pairs = pairs.distinct().join(starred, ["a", "b"], "left_anti")
    links = links.union(materialize(verify(pairs, sets, percent)))
    # 3. long lists: clusters, block against block
    long_lists = all_lists.select("token", "k", "rep", (F.col("open") & (F.col("k") > SMALL_LIST)).alias("long"))
    long = join_by_weight(postings, long_lists, ["token"], "k", F.col("s"), keep="long").select(
        F.col("rep").alias("a"), F.col("s").alias("b")
    )
    members = materialize(
        connected_components(long).select(F.col("id").alias("s"), F.col("root").alias("cluster")).join(classes, "s")
    )
    largest = members.groupBy("cluster", "class").count()
    summary = (
        largest.groupBy("cluster")
        .agg(F.max_by("class", F.struct("count", "class")).alias("main"), F.sum("count").alias("m"), F.max("count").alias("m1"))
        .withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
        .withColumn("stray_blocks", F.greatest(F.ceil((F.col("m") - F.col("m1")) / BLOCK), F.lit(1)).cast("int"))
        .drop("m", "m1")
    )
    placed = members.join(summary, "cluster").join(sets.select("s", "tokens"), "s")
    slot = F.pmod(F.xxhash64("s", F.lit(7)), F.col("blocks")).cast("int")
    stray_slot = F.pmod(F.xxhash64("s", F.lit(11)), F.col("stray_blocks")).cast("int")
    ids = ["cluster", "s", "class", "tokens"]
    lefts = placed.filter("class != main").select(
        *ids, F.lit(True).alias("left"), stray_slot.alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"),
    )
    rights = placed.select(
        *ids, F.lit(False).alias("left"),
        F.explode(F.sequence(F.lit(0), F.col("stray_blocks") - 1)).alias("i"), slot.alias("j"),
    )
    found = lefts.unionByName(rights).groupBy("cluster", "i", "j").applyInPandas(
        _block_links(percent), "a bigint, b bigint"
    )
    return links.union(materialize(found))


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row; the class is its least id."""
    sampled = materialize(sample_tokens(docs, id_col, text_col, words, percent))
    heads = materialize(prefixes(sampled, percent))
    wanted = heads.select(F.col("doc_id").alias(id_col))
    if wanted.count() <= SMALL_BROADCAST:
        wanted = F.broadcast(wanted)
    texts = docs.select(id_col, text_col).join(wanted, id_col, "left_semi")
    sets = materialize(
        heads.join(token_sets(texts, id_col, text_col, words).dropDuplicates(["s"]), "s")
    )
    roots = connected_components(set_links(sets, percent)).withColumnRenamed("id", "s")
    texts = sampled.filter("n IS NOT NULL").select("doc_id", "n", "s")
    held = texts.filter("n > 0")
    least = held.groupBy("s").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    named = materialize(roots.join(least, "s"))
    of_root = named.groupBy("root").agg(F.min("least").alias("component"))
    in_class = with_row(named, materialize(of_root), "root").select("s", "component")
    of_set = materialize(
        least.join(in_class, "s", "left").select("s", "copies", F.coalesce("component", "least").alias("component"))
    )
    n_shingles = F.col("n").cast("bigint").alias("n_shingles")
    # one set may be that of very many texts
    told = join_by_weight(held, of_set, ["s"], "copies", F.col("doc_id"))
    return told.select("doc_id", n_shingles, F.col("component").alias("component_id")).unionAll(
        texts.filter("n = 0").select("doc_id", n_shingles, F.col("doc_id").alias("component_id"))
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class, the one with the least id; columns unchanged.

    Rows of one id stay or go together; rows without an id stay.
    """
    classes = jaccard_classes(docs, id_col, text_col)
    dropped = materialize(
        classes.filter("doc_id != component_id").select(F.col("doc_id").alias(id_col)).distinct()
    )
    if dropped.count() <= SMALL_BROADCAST:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, id_col, "left_anti").select(*docs.columns)
