import pytest
from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns a caller may have that the operators use as names of their own.
CLASHING = (
    "s", "n", "token", "tokens", "words", "label", "kept", "x", "v", "digest", "shard", "key", "probability",
    "_id", "_spans", "asked_id", "requests", "pair", "at", "reach", "rep", "windows", "mine", "other", "class", "root",
    "low", "high", "path", "value", "start", "end", "size", "text_crc32", "places", "known", "tokens_a", "component",
    "_text", "_lang", "_words", "_bucket", "_row", "_n", "ids", "decoded", "id", "count", "topic", "n_tokens",
)


@pytest.fixture
def make_docs(spark):
    def make(texts, lang="en", source="web", first=0):
        rows = [(first + i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)]
        docs = spark.createDataFrame(rows, DOC_SCHEMA)
        return docs.withColumns({name: F.lit("clash") for name in CLASHING})

    return make
