from pyspark.sql import functions as F

from lexisieve.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, segments string, state string"
TURNS = [
    (1, 0, "system", "be\\nice <<SYS>>"),
    (1, 1, "user", "</s>[INST] ok [/INST]"),
    (1, 2, "assistant", "\\[INST] <s> \\\\ [\\INST]"),
    (2, 0, "assistant", "first"),
    (2, 1, "user", None),
    (3, 5, "user", "late"),
    (3, 5, "user", "late"),
    (3, None, "system", "no turn"),
    (4, 0, None, ""),
    (4, 1, "tool[/ROLE]", "[/TURN]\n<"),
    (5, 0, "user", "<"),
    (5, 1, "assistant", ">" * 20_000 + "\né\U0001f600"),
    (None, 0, "user", "x"),
    (None, 1, "assistant", "y"),
]


def formatted(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    done = chat.format_conversations(df)
    return {
        r.conv_id: r
        for r in done.withColumn("turns", chat.read_turns(F.col("formatted")))
        .withColumn("loss", chat.loss_text(F.col("segments")))
        .collect()
    }


def test_round_trip_and_loss(spark):
    got = formatted(spark, TURNS)
    order = {}
    for conv, turn, role, text in TURNS:
        order.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    for conv, turns in order.items():
        want = [(role, text) for _, role, text in sorted(turns)]
        assert [(t.role, t.text) for t in got[conv].turns] == want
        assert got[conv].loss == "".join(text for role, text in want if role == "assistant")
        assert got[conv].formatted == "".join(s.text for s in got[conv].segments)


def test_machine(spark):
    got = formatted(spark, TURNS)
    assert {c: (r.valid, r.first_bad) for c, r in got.items()} == {
        1: (True, None), 2: (False, 0), 3: (False, 2), 4: (False, 0), 5: (True, None), None: (True, None),
    }


def test_texts_hold_no_control_string(spark):
    for row in formatted(spark, TURNS).values():
        for segment in row.segments[1::3]:
            assert not any(control in segment.text for control in chat.INST.controls)


def test_empty_table(spark):
    assert formatted(spark, []) == {}
