import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from lexisieve.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = ["a", "aa", "the", "ing", " ", "  ", "\n", "'s", "'l", "l", "é", "漢字", "\U0001f600", "12", "...", "\t"]


@pytest.fixture(scope="module")
def pairs():
    return bpe.load(PATH, PATTERN)


@pytest.fixture(scope="module")
def reference(pairs):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=pairs.ranks, special_tokens={})


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(n)]


def test_equals_the_library(pairs, reference):
    for text in texts(4000, 1):
        assert np.frombuffer(pairs.encode(text), np.int32).tolist() == reference.encode_ordinary(text)


def test_every_prefix_and_edits_near_it(pairs, reference):
    rng = random.Random(2)

    def single(piece):
        return reference._encode_single_piece(piece) if piece else []

    for _ in range(400):
        piece = bytes(rng.choices(b"abcdeing t", k=rng.randint(1, 60)))
        table = bpe.PrefixTable(pairs, piece[:7])
        table.append(piece[7:])
        for end in (len(piece), len(piece) // 2):
            if piece[:end] not in pairs.ranks:
                assert table.tokens(end) == single(piece[:end])
        start = rng.randint(0, len(piece))
        stop = rng.randint(start, len(piece))
        new = bytes(rng.choices(b"abing", k=3))
        table.edit(start, stop, new)
        after = piece[:start] + new + piece[stop:]
        if after not in pairs.ranks:
            assert table.tokens() == single(after)


def test_edits_of_long_strings_stay_local(pairs, reference):
    piece = bytes(random.Random(3).choices(b"abcdefghij", k=5000))
    table = bpe.PrefixTable(pairs, piece)
    assert table.edit(100, 101, b"z") < 500
    assert table.tokens() == reference._encode_single_piece(piece[:100] + b"z" + piece[101:])


def test_appending_text(pairs, reference):
    for text in texts(300, 4):
        encoded = bpe.EncodedText(pairs)
        for at in range(0, len(text), 3):
            encoded.append(text[at : at + 3])
        assert encoded.tokens() == reference.encode_ordinary(text)


def test_tables_forget_but_stay_right(reference):
    small = bpe.BytePairs(bpe.load(PATH, PATTERN).ranks, PATTERN)
    small.pieces.most = small.together.most = small.edges.most = 5
    for text in texts(200, 5):
        assert np.frombuffer(small.encode(text), np.int32).tolist() == reference.encode_ordinary(text)


def test_columns(spark, make_docs, reference):
    given = [None, "", "plain words", "x" * 50_000, "same", "same", *texts(50, 6)]
    docs = make_docs(given).select("doc_id", "text", bpe.encode(F.col("text"), PATH, PATTERN).alias("ids"))
    rows = docs.withColumn("back", bpe.decode(F.col("ids"), PATH, PATTERN)).orderBy("doc_id").collect()
    for text, row in zip(given, rows):
        assert row.ids == reference.encode_ordinary(text or "")
        assert bytes(row.back) == (text or "").encode()
    assert make_docs([]).select(bpe.encode(F.col("text"), PATH, PATTERN).alias("ids")).count() == 0


def test_rows_of_a_table_and_freed_tables(spark, reference):
    rows = [(i, t, "clash") for i, t in enumerate([None, "", "x" * 9000, *texts(50, 9)])]
    df = spark.createDataFrame(rows, "doc_id bigint, body string, decoded string")
    done = bpe.encode_rows(df, ["doc_id"], PATH, PATTERN, "body").collect()
    for (i, text, _), row in zip(rows, sorted(done)):
        assert row.doc_id == i and list(row.ids) == reference.encode_ordinary(text or "")
        assert bytes(row.decoded).decode() == (text or "")
    assert bpe.encode_rows(df.limit(0), ["doc_id"], PATH, PATTERN, "body").count() == 0


def test_tables_hold_no_more_than_they_say():
    table = bpe._Table(lambda key: key, 100)
    for key in range(1000):
        assert table[key] == key and len(table) + len(table.older) <= 101
    table.forget()
    assert not table and not table.older
