"""Mixing to target weights: iterative proportional fitting, then calibrated sampling.

Documents are counted once into cells, one for each combination of source, language and
topic. The cells' token weights are raked: scaled to each margin's target totals in turn,
and cut at the tokens a cell has, until a round changes no value's total by more than
``tolerance`` of it, however small the value. `margin_gaps` tells for each value what was
fitted, whether it met its target, and whether the value has as many tokens at all. A document is
kept if the hash of its id falls below its cell's probability, the fitted share of its
cell's tokens, so the sample's expected token totals are those fitted.

Targets are token totals for each value of each margin. Without given ones they are the
budget (a share of all tokens), divided in proportion to a value's tokens to the power
``flatten``, which lifts small sources, languages and topics.

Cells are a table, and so may be as many as the data has; raking is aggregations and
joins on them. Document rows meet their cell's probability in a join in which cells of
many documents are split.

Defined results: null is a value of its own in each margin; null or empty text has no
tokens and is kept with its cell's probability, 0 if the whole cell is empty; repeated
rows and equal ids share their fate; an empty table gives an empty result; other columns
stay as they are in `sample_mixture` and are not looked at in `mixture`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisieve.llm.common import split_words
from lexisieve.operators.skew import join_by_weight
from lexisieve.session import materialize

PLACES = 12


@dataclass(frozen=True)
class Mixture:
    """What to rake to. ``rounds`` is a ceiling; fitting ends earlier once no value of a margin
    moves by more than ``tolerance`` of its total."""

    margins: tuple[str, ...] = ("source", "lang", "topic")
    budget: float = 0.5
    flatten: float = 0.7
    tolerance: float = 1e-3
    rounds: int = 30
    seed: int = 539


def topic_of(text: Column) -> Column:
    """A document's topic by its form: table, contact data, figures, lines or prose."""
    text = F.coalesce(text, F.lit(""))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    bars = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    return (
        F.when(bars * 50 > F.length(text), "table")
        .when(text.contains("@"), "contact")
        .when(text.rlike("[0-9]"), "figures")
        .when(lines * 300 > F.length(text), "lines")
        .otherwise("prose")
    )


def token_count(text: Column) -> Column:
    return F.size(split_words(text)).cast("bigint")


def _value(margin: str) -> Column:
    """The margin's value as a string; null is ``-``, any other value starts with ``=``."""
    return F.coalesce(F.concat(F.lit("="), F.col(margin).cast("string")), F.lit("-"))


def margin_totals(cells: DataFrame, margins: tuple[str, ...], weight: str = "tokens") -> DataFrame:
    """``(margin, value, total)`` of ``weight`` for every margin."""
    pairs = F.array(*[F.struct(F.lit(m).alias("margin"), F.col(m).alias("value")) for m in margins])
    return (
        cells.select(F.col(weight).alias("w"), F.explode(pairs).alias("p"))
        .groupBy("p.margin", "p.value")
        .agg(F.sum("w").alias("total"))
    )


def flattened_targets(cells: DataFrame, mixture: Mixture) -> DataFrame:
    """``(margin, value, target)``: the budget, divided by flattened token shares."""
    totals = margin_totals(cells, mixture.margins).withColumn("power", F.pow("total", F.lit(mixture.flatten)))
    sums = totals.groupBy("margin").agg(F.sum("power").alias("all_power"), F.sum("total").alias("all_tokens"))
    return totals.join(sums, "margin").select(
        "margin",
        "value",
        F.coalesce(
            F.try_divide(F.col("power"), F.col("all_power")) * F.col("all_tokens") * mixture.budget, F.lit(0.0)
        ).alias("target"),
    )


def rake(cells: DataFrame, targets: DataFrame, mixture: Mixture) -> DataFrame:
    """``cells`` with ``weight``: fitted tokens, never more than the cell's ``tokens``.

    ``targets`` is ``(margin, value, target)``. A value without a target gets none.
    """
    # a cell carries its targets, so a step needs no join but the one with its margin's sums
    goals = {margin: f"_goal_{margin}" for margin in mixture.margins}
    fitted = cells.withColumn("weight", F.col("tokens").cast("double"))
    targets = materialize(targets)
    for margin, goal in goals.items():
        of_margin = targets.filter(F.col("margin") == margin).select(
            F.col("value").alias(margin), F.col("target").alias(goal)
        )
        fitted = fitted.join(of_margin, margin, "left")
    fitted = materialize(fitted)
    for _ in range(mixture.rounds):
        step = fitted.withColumn("_before", F.col("weight"))
        for margin, goal in goals.items():
            now = step.groupBy(margin).agg(F.sum("weight").alias("_now"))
            factor = F.coalesce(F.try_divide(F.col(goal), F.col("_now")), F.lit(0.0))
            step = step.join(now, margin).withColumn(
                "weight", F.least(F.col("weight") * factor, F.col("tokens").cast("double"))
            ).drop("_now")
        step = materialize(step)
        pairs = F.array(*[F.struct(F.lit(m).alias("margin"), F.col(m).alias("value")) for m in goals])
        moved = (
            step.select(F.abs(F.col("weight") - F.col("_before")).alias("m"), "weight", F.explode(pairs).alias("p"))
            .groupBy("p.margin", "p.value")
            .agg(F.try_divide(F.sum("m"), F.sum("weight")).alias("moved"))
        )
        most = moved.agg(F.max("moved")).first()[0]
        fitted = step.drop("_before")
        if most is None or most <= mixture.tolerance:
            break
    return fitted.drop(*goals.values())


def margin_gaps(fitted: DataFrame, targets: DataFrame, mixture: Mixture) -> DataFrame:
    """``(margin, value, target, fitted, available, reachable, met)`` for cells from `rake`.

    ``reachable`` says whether the value has as many tokens as its target, ``met`` whether
    the fitted total is within 1 percent of it. A reachable target may be missed where the
    cells it needs are used up by other margins' targets.
    """
    have = margin_totals(fitted, mixture.margins).withColumnRenamed("total", "available")
    got = margin_totals(fitted, mixture.margins, "weight").withColumnRenamed("total", "fitted")
    joined = have.join(got, ["margin", "value"]).join(targets, ["margin", "value"], "full")
    target, available = F.coalesce("target", F.lit(0.0)), F.coalesce("available", F.lit(0)).cast("double")
    total = F.coalesce("fitted", F.lit(0.0))
    return joined.select(
        "margin", "value", target.alias("target"), total.alias("fitted"), available.alias("available"),
        (available >= target * 0.999).alias("reachable"),
        (F.abs(total - target) <= 0.01 * target).alias("met"),
    )


def mixture_report(rows: DataFrame, plan: Mixture = Mixture(), targets: DataFrame | None = None) -> DataFrame:
    """`margin_gaps` of what `mixture` fits to ``rows``."""
    cells = token_cells(rows, plan)
    targets = flattened_targets(cells, plan) if targets is None else targets
    return margin_gaps(rake(cells, targets, plan), targets, plan)


def token_cells(rows: DataFrame, plan: Mixture) -> DataFrame:
    """Tokens and rows of each combination of the margins' values, written once."""
    marked = rows.select("n_tokens", *[_value(m).alias(m) for m in plan.margins])
    return materialize(marked.groupBy(*plan.margins).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")))


def _lot(id_col: Column, seed: int) -> Column:
    """A number from 0 up to 1 that depends on the id and the seed alone."""
    return F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)


def mixture(
    rows: DataFrame, plan: Mixture = Mixture(), id_col: str = "doc_id", targets: DataFrame | None = None
) -> DataFrame:
    """``rows`` with ``probability`` and ``kept``.

    ``rows`` holds the margins, ``n_tokens`` and the id. They are read twice.
    """
    marked = rows.select("*", *[_value(m).alias(f"_{m}") for m in plan.margins])
    keys = [f"_{m}" for m in plan.margins]
    cells = token_cells(rows, plan)
    fitted = rake(cells, flattened_targets(cells, plan) if targets is None else targets, plan)
    probability = F.round(F.coalesce(F.try_divide(F.col("weight"), F.col("tokens")), F.lit(0.0)), PLACES)
    chances = materialize(
        fitted.select(*[F.col(m).alias(f"_{m}") for m in plan.margins], "n", probability.alias("probability"))
    )
    joined = join_by_weight(marked, chances, keys, "n", F.col(id_col))
    return joined.withColumn("kept", _lot(F.col(id_col), plan.seed) < F.col("probability")).drop("n", *keys)


def sample_mixture(docs: DataFrame, plan: Mixture = Mixture(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows of ``docs``, columns unchanged; margins are source, language and topic of the text."""
    rows = docs.select(
        F.struct("*").alias("_row"),
        F.col(id_col).alias("_id"),
        *[F.col(m) for m in plan.margins if m != "topic"],
        topic_of(F.col(text_col)).alias("topic"),
        token_count(F.col(text_col)).alias("n_tokens"),
    )
    return mixture(rows, plan, "_id").filter("kept").select("_row.*")
