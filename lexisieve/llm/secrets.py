"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are runs of key-like characters that hold a digit or are very long, and values
assigned to a name such as ``password``, whole: runs inside them are part of them. A forest
decides which are secrets, from their length, the kinds of characters and how often they
change, how much of them dictionary words cover, the path (source) they come from, and the
words next to them.

It is trained on labelled findings: `label_findings` labels the clear cases of a corpus by
rule (known key formats and mixed values under a secret's name against plain numbers, plain
words, and UUIDs, hex digests and timestamps that are not assigned) and leaves the others
open; own labelled findings may be given instead. Labels only train. There are two forests,
each fitted on one half of the findings by hash, and a finding is scored by the forest that
was not fitted on it (`held_out` therefore gives held-out precision and recall). At most
``fit_rows`` of each label are used for a fit, those with the least hashes. The dictionary
holds the ``dictionary_words`` most frequent words of all texts.

Defined results: null or empty text has no candidates; an empty table gives an empty
result; a half without findings of both labels is scored by the other half's forest, and
without any forest nothing is removed and scores are 1; rows with equal ids are scanned one
by one, but `redact` needs one row an id, rows with a null id are scanned and not redacted;
other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisieve.llm.common import free_memory, split_words
from lexisieve.session import materialize

# --- fixed values: candidate patterns, names of secrets, known key formats ----

RUN = re.compile(r"[A-Za-z0-9+/_\-]{10,}={0,2}")
ASSIGNED = re.compile(
    r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?[ \t]*[:=][ \t]*[\"']?([^\s\"']{6,})"
)
SECRET_NAMES = r"(?i)^(password|passwd|pwd|secret|token|key|apikey|api_key|api-key|access_key|credential)$"
KNOWN_KEYS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})$"
UUIDS = r"(?i)^[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}$"
DIGESTS = r"(?i)^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"
TIMESTAMPS = r"^[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T_-][0-9]{2,6}Z?$"

PLAIN_RUN, CONTEXT = 24, 48
BEFORE = re.compile(r"([A-Za-z_\-]+)[\"']?[\s:=\"']*$")
AFTER = re.compile(r"^[\"']?\W*([A-Za-z_\-]+)")
SMALL_BROADCAST = 200_000
# Rows of a batch that are Python texts at a time.
CHUNK = 500


@dataclass(frozen=True)
class SecretScan:
    fit_rows: int = 10_000
    dictionary_words: int = 2000
    threshold: float = 0.5
    trees: int = 40
    depth: int = 8
    seed: int = 539


class Dictionary:
    def __init__(self, words: list[str]):
        self.words, self.longest = set(words), max(map(len, words), default=0)

    def coverage(self, value: str) -> float:
        """Share of the characters that words cover, longest words first from the left."""
        low, at, covered = value.lower(), 0, 0
        while at < len(low):
            sizes = range(min(self.longest, len(low) - at), 2, -1)
            size = next((n for n in sizes if low[at : at + n] in self.words), 0)
            covered += size
            at += size or 1
        return covered / max(len(low), 1)


def find_candidates(text: str) -> list[tuple[int, int, str, str, bool]]:
    """``(start, end, word before, word after, assigned)`` of every candidate, in code points."""
    # a value takes in the runs inside it; a run that reaches into one ends where it starts
    found: list[tuple[int, int]] = []
    values = [m.span(1) for m in ASSIGNED.finditer(text)] if "=" in text or ":" in text else []
    at = 0
    for m in RUN.finditer(text):
        run, (start, end) = m.group(), m.span()
        if len(run) < PLAIN_RUN and not any(map(str.isdigit, run)):
            continue
        while at < len(values) and values[at][1] <= start:
            found.append(values[at])
            at += 1
        if at == len(values):
            found.append((start, end))
        elif start < values[at][0]:
            found.append((start, min(end, values[at][0])))
    found += values[at:]
    out = []
    for start, end in found:
        left = text[max(0, start - CONTEXT) : start]
        before, after = BEFORE.search(left), AFTER.search(text[end : end + CONTEXT])
        out.append(
            (
                start,
                end,
                before.group(1) if before else "",
                after.group(1) if after else "",
                left.rstrip(" \t\"'").endswith(("=", ":")),
            )
        )
    return out


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
    words: list[str] | None = None,
) -> DataFrame:
    """``(doc_id, path, start, end, value, before, after, assigned, coverage)`` of all candidates."""
    schema = (
        "doc_id bigint, path string, start int, end int, value string, before string, after string,"
        " assigned boolean, coverage double"
    )
    known = Dictionary(words or [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = None
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                rows = []
                for doc, path, text in zip(*(c.slice(at, CHUNK).to_pylist() for c in batch.columns)):
                    for start, end, before, after, assigned in find_candidates(text or ""):
                        value = text[start:end]
                        rows.append((doc, path, start, end, value, before, after, assigned, known.coverage(value)))
                columns = list(zip(*rows)) if rows else [()] * len(types)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types.values())], list(types)
                )
        del batch
        free_memory()

    types = {
        "doc_id": pa.int64(), "path": pa.string(), "start": pa.int32(), "end": pa.int32(), "value": pa.string(),
        "before": pa.string(), "after": pa.string(), "assigned": pa.bool_(), "coverage": pa.float64(),
    }
    return docs.select(F.col(id_col).cast("bigint"), F.col(path_col).cast("string"), F.col(text_col)).mapInArrow(
        run, schema
    )


def dictionary(docs: DataFrame, size: int, text_col: str = "text") -> list[str]:
    """The most frequent words of three letters or more over all texts; ``size`` bounds the list."""
    words = docs.select(F.explode(split_words(F.lower(text_col), r"[^\p{L}]+")).alias("word"))
    counted = words.filter(F.length("word") >= 3).groupBy("word").count()
    return [r["word"] for r in counted.orderBy(F.desc("count"), "word").limit(size).collect()]


def label_findings(findings: DataFrame) -> DataFrame:
    """``findings`` with ``label``: 1.0 and 0.0 for clear cases, else null."""
    value = F.col("value")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    named = F.col("assigned") & F.col("before").rlike(SECRET_NAMES)
    plain = value.rlike("^[0-9_+/-]+$") | value.rlike("^[A-Za-z_+/-]+$")
    formal = value.rlike(UUIDS) | value.rlike(DIGESTS) | value.rlike(TIMESTAMPS)
    return findings.withColumn(
        "label",
        F.when(value.rlike(KNOWN_KEYS) | (named & mixed), 1.0)
        .when((plain & ~named) | (formal & ~F.col("assigned")), 0.0),
    )


def _features() -> Column:
    value = F.col("value")
    length = F.length(value).cast("double")
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / length
    bucket = lambda text, n: F.pmod(F.xxhash64(F.lower(F.coalesce(text, F.lit("")))), F.lit(n)).cast("double")
    return F.array(
        length,
        share("[0-9]"),
        share("[A-Z]"),
        share("[a-z]"),
        share("(?<=[a-z])[0-9]"),
        share("(?<=[0-9])[a-z]"),
        share("(?<=[A-Z])[0-9]"),
        share("(?<=[0-9])[A-Z]"),
        share("(?<=[a-z])[A-Z]"),
        F.size(F.array_distinct(F.split(value, ""))) / length,
        F.col("coverage"),
        F.col("assigned").cast("double"),
        F.col("before").rlike(SECRET_NAMES).cast("double"),
        bucket(F.col("path"), 64),
        bucket(F.col("before"), 256),
        bucket(F.col("after"), 256),
    )


def fit(labelled: DataFrame, settings: SecretScan = SecretScan()) -> RandomForestClassificationModel | None:
    """A forest on at most ``fit_rows`` rows ``(x, label)`` of each label; None without both labels."""
    order = F.xxhash64("doc_id", "start", F.lit(settings.seed))
    parts = [
        labelled.filter(F.col("label") == label).orderBy(order, "doc_id", "start").limit(settings.fit_rows)
        for label in (0.0, 1.0)
    ]
    rows = materialize(parts[0].union(parts[1]).select("x", "label").coalesce(1))
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="v", labelCol="label", numTrees=settings.trees, maxDepth=settings.depth, seed=settings.seed
    )
    return forest.fit(rows.select("label", array_to_vector("x").alias("v")))


def scan_secrets(
    docs: DataFrame,
    settings: SecretScan = SecretScan(),
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
    labelled: DataFrame | None = None,
) -> DataFrame:
    """All candidates with ``label``, ``score`` (the forest's probability) and ``secret``.

    ``labelled`` findings, in the columns of `scan` and ``label``, replace labels by rule.
    """
    words = dictionary(docs, settings.dictionary_words, text_col)
    found = materialize(
        label_findings(scan(docs, id_col, text_col, path_col, words)).withColumn("x", _features())
    )
    return score(found, found if labelled is None else labelled.withColumn("x", _features()), settings)


def _half(settings: SecretScan) -> Column:
    return F.pmod(F.xxhash64("doc_id", "start", F.lit(settings.seed + 1)), F.lit(2)).cast("int")


def score(found: DataFrame, labelled: DataFrame, settings: SecretScan = SecretScan()) -> DataFrame:
    """``found(.., x)`` with the score of the forest that was fitted on the other half's labels."""
    half = _half(settings)
    halves = [fit(labelled.filter(half != i), settings) for i in (0, 1)]
    scored = found.withColumn("v", array_to_vector("x"))
    names = []
    for i, model in enumerate(halves):
        model = model or halves[1 - i]
        names.append(F.lit(1.0))
        if model is not None:
            probability = vector_to_array("probability")[1]
            scored = (
                model.transform(scored)
                .withColumn(f"by_{i}", probability)
                .drop("rawPrediction", "probability", "prediction")
            )
            names[-1] = F.col(f"by_{i}")
    scored = scored.withColumn("score", F.round(F.when(half == 0, names[0]).otherwise(names[1]), 9))
    return scored.select(
        "doc_id", "path", "start", "end", "value", "before", "after", "assigned", "label", "score",
        (F.col("score") >= settings.threshold).alias("secret"),
    )


def held_out(scored: DataFrame) -> DataFrame:
    """``(findings, precision, recall)`` over the labelled findings; no forest was fitted on what it scores."""
    known = scored.filter("label IS NOT NULL")
    right = F.count_if(F.col("secret") & (F.col("label") == 1))
    return known.agg(
        F.count("*").alias("findings"),
        F.try_divide(right, F.count_if(F.col("secret"))).alias("precision"),
        F.try_divide(right, F.count_if(F.col("label") == 1)).alias("recall"),
    )


def redact(
    docs: DataFrame, findings: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with every secret of ``findings`` replaced by ``mark``; no row goes."""
    own_id, own_spans = (f"_{name}_{uuid.uuid4().hex}" for name in ("id", "spans"))  # clash with no column
    spans = materialize(
        findings.filter("secret AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias(own_id))
        .agg(F.sort_array(F.collect_set(F.struct("start", "end")), asc=False).alias(own_spans))
    )
    if spans.count() <= SMALL_BROADCAST:
        spans = F.broadcast(spans)

    def cut(text: Column, span: Column) -> Column:
        rest = F.substring(text, span["end"] + 1, F.length(text))
        return F.concat(F.substring(text, F.lit(1), span["start"]), F.lit(mark), rest)

    none = F.array().cast("array<struct<start:int,end:int>>")
    redacted = F.aggregate(F.coalesce(own_spans, none), F.col(text_col), cut)
    return (
        docs.join(spans, F.col(id_col) == F.col(own_id), "left")
        .withColumn(text_col, F.when(F.col(own_spans).isNull(), F.col(text_col)).otherwise(redacted))
        .select(*docs.columns)
    )
