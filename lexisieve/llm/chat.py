"""Chat formatting: conversations as marked text with a loss flag per segment.

A template declares the marks around each role's text, which roles are trained on, and
a finite-state machine over roles. The machine says whether a conversation's turns come
in a legal order and where they first do not; every conversation is formatted all the
same, so that nothing is lost. Control strings inside a text are broken up with a
backslash after their first character, and backslashes are doubled, so `read_turns`
gives back exactly what went in.

Native: one shuffle of the turns by conversation; a row is as large as its conversation.

Defined results: null text and null role are empty; roles that the template does not
know are kept under a generic mark and are never legal; a null turn comes first, equal
turns go by role and text; repeated rows are turns of their own; a null id is a
conversation of its own; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class ChatTemplate:
    """Marks and machine; ``moves[state][role]`` is the next state, absent if illegal."""

    marks: dict[str, tuple[str, str]]
    other: tuple[str, str, str]  # before the role, before the text, after the text
    moves: dict[str, dict[str, str]]
    start: str
    accepting: frozenset[str]
    loss_roles: frozenset[str]
    controls: tuple[str, ...] = field(default=())


INST = ChatTemplate(
    marks={
        "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": ("[INST] ", " [/INST]"),
        "assistant": ("<s>", "</s>"),
    },
    other=("[ROLE]", "[/ROLE]", "[/TURN]"),
    moves={
        "start": {"system": "instructed", "user": "asked"},
        "instructed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    },
    start="start",
    accepting=frozenset({"answered"}),
    loss_roles=frozenset({"assistant"}),
    controls=(
        "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[/TURN]",
    ),
)


def escape(text: Column, template: ChatTemplate = INST) -> Column:
    """No control string of the template is left in the result."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for control in template.controls:
        text = F.replace(text, F.lit(control), F.lit(control[0] + ESCAPE + control[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    found = F.lit(None).cast("string")
    for name, value in pairs.items():
        found = F.when(key == name, F.lit(value)).otherwise(found)
    return found


def check_order(turns: Column, template: ChatTemplate = INST) -> Column:
    """Struct ``(state, first_bad)`` after all turns; ``first_bad`` counts from 0, null if none.

    After an illegal turn the machine goes on as if it had come to that turn legally.
    """
    steps = {f"{state} {role}": to for state, by_role in template.moves.items() for role, to in by_role.items()}
    resume = {role: to for by_role in template.moves.values() for role, to in by_role.items()}

    def step(acc: Column, turn: Column) -> Column:
        legal = _lookup(steps, F.concat(acc["state"], F.lit(" "), turn["role"]))
        bad = F.when(legal.isNull(), acc["at"])
        return F.struct(
            F.coalesce(legal, _lookup(resume, turn["role"]), acc["state"]).alias("state"),
            F.coalesce(acc["first_bad"], bad).alias("first_bad"),
            (acc["at"] + 1).alias("at"),
        )

    zero = F.struct(
        F.lit(template.start).alias("state"),
        F.lit(None).cast("bigint").alias("first_bad"),
        F.lit(0).cast("bigint").alias("at"),
    )
    return F.aggregate(turns, zero, step)


def _segments(turn: Column, template: ChatTemplate) -> Column:
    """A turn's mark, text and mark, each with its loss flag."""
    open_other, mid_other, close_other = template.other
    before = F.concat(F.lit(open_other), escape(turn["role"], template), F.lit(mid_other))
    after = F.lit(close_other)
    for role, (left, right) in template.marks.items():
        before = F.when(turn["role"] == role, F.lit(left)).otherwise(before)
        after = F.when(turn["role"] == role, F.lit(right)).otherwise(after)

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    trained = turn["role"].isin(sorted(template.loss_roles))
    return F.array(
        segment(before, F.lit(False)),
        segment(escape(turn["text"], template), trained),
        segment(after, F.lit(False)),
    )


def format_conversations(
    turns: DataFrame,
    template: ChatTemplate = INST,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Per conversation: ``segments``, their concatenation ``formatted``, ``valid``, ``first_bad``.

    ``valid`` needs a legal order and an accepting last state.
    """
    gathered = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col(turn_col).alias("turn"),
                    F.coalesce(role_col, F.lit("")).alias("role"),
                    F.coalesce(text_col, F.lit("")).alias("text"),
                )
            )
        ).alias("_turns")
    )
    return (
        gathered.withColumn("_order", check_order(F.col("_turns"), template))
        .withColumn("segments", F.flatten(F.transform("_turns", lambda t: _segments(t, template))))
        .select(
            "conv_id",
            "segments",
            F.array_join("segments.text", "").alias("formatted"),
            (
                F.col("_order.first_bad").isNull()
                & F.col("_order.state").isin(sorted(template.accepting))
            ).alias("valid"),
            F.col("_order.first_bad").alias("first_bad"),
        )
    )


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in r"\[](){}.*+?^$|" else c for c in text)


def read_turns(formatted: Column, template: ChatTemplate = INST) -> Column:
    """Array of ``(role, text)`` as they went in."""
    marks = list(template.marks.values())
    open_other, mid_other, close_other = template.other
    whole = [f"{_quoted(a)}.*?{_quoted(b)}" for a, b in marks]
    whole.append(".*?".join(_quoted(x) for x in template.other))
    found = F.regexp_extract_all(formatted, F.lit("(?s)" + "|".join(whole)), F.lit(0))

    def between(turn: Column, left: str, right: str) -> Column:
        return F.substring(turn, F.lit(len(left) + 1), F.length(turn) - len(left) - len(right))

    def parsed(turn: Column) -> Column:
        rest = between(turn, open_other, close_other)
        role = F.substring_index(rest, mid_other, 1)
        text = F.substring(rest, F.length(role) + len(mid_other) + 1, F.length(rest))
        role = unescape(role)
        for name, (left, right) in template.marks.items():
            mine = F.startswith(turn, F.lit(left))
            role = F.when(mine, F.lit(name)).otherwise(role)
            text = F.when(mine, between(turn, left, right)).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(found, parsed)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
