"""Independent SQL (DuckDB dialect) for the queries SQL can express."""

from __future__ import annotations

import re

from catalog.views import with_views
from lexisieve.functions.normalize import CONTRACTIONS
from lexisieve.operators.labels import LABEL_MEANINGS

ORACLE: dict[str, str] = {}

WORD = r"[\p{L}\p{N}_]"
BLANK = r"[\t\n\x0b\f\r\x1c-\x1f\x85\p{Z}]"
RAW = "coalesce(TEXT, '')"


def _sub(text: str, pattern: str, replacement: str, options: str = "g") -> str:
    quoted = [part.replace("'", "''") for part in (pattern, replacement)]
    return f"regexp_replace({text}, '{quoted[0]}', '{quoted[1]}', '{options}')"


def _collapse(text: str) -> str:
    return f"trim({_sub(text, BLANK + '+', ' ')}, ' ')"


def _key(text: str) -> str:
    return f"replace(lower({_collapse(text)}), 'ß', 'ss')"


def _report_key(text: str) -> str:
    return _collapse(f"lower({text})")


def _count(text: str, pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"len(regexp_extract_all({text}, '{quoted}'))"


# --- contracts ----------------------------------------------------------------

ORACLE["scan_corpus"] = with_views("SELECT ID, row_idx, TEXT FROM v_doc", "v_doc")

SOME_LABELS = """SELECT ID, row_idx, CASE row_idx % 11 WHEN 0 THEN 'x' WHEN 1 THEN '1.5' WHEN 2 THEN '7'
    WHEN 3 THEN NULL WHEN 4 THEN '2.0' WHEN 5 THEN ' 1' WHEN 6 THEN 'nan' WHEN 7 THEN 'inf'
    ELSE CAST(row_idx % 3 AS VARCHAR) END AS LABEL FROM v_doc"""
NUMBERS = "SELECT *, TRY_CAST(trim(LABEL) AS DOUBLE) AS num FROM labelled"


def _on_labels(body: str, **more: str) -> str:
    return with_views(body, "v_doc", labelled=SOME_LABELS, numbers=NUMBERS, **more)


def _id_problems(name: str, col: str) -> str:
    return f"""SELECT '{name}' AS source,
        (SELECT count(*) FROM {name} WHERE {col} IS NULL) AS missing,
        (SELECT count(*) FROM {name} WHERE trim(coalesce(CAST({col} AS VARCHAR), '')) = '') AS blank,
        (SELECT count(*) FROM {name} WHERE {col} IN
            (SELECT {col} FROM {name} GROUP BY 1 HAVING count(*) > 1)) AS duplicates"""


ORACLE["validate_ids"] = " UNION ALL ".join(
    _id_problems(n, c)
    for n, c in (
        ("documents", "doc_id"), ("conversations", "conv_id"), ("lineitem", "l_orderkey"), ("pages", "url"),
    )
)

ORACLE["validate_labels"] = _on_labels(
    """SELECT count(*) FILTER (num IS NULL OR isnan(num)) AS unparseable,
        count(*) FILTER (isfinite(num) AND abs(num - round(num)) > 1e-8 + 1e-5 * abs(round(num))) AS not_integer,
        count(*) FILTER (NOT isnan(num) AND num = round(num) AND num NOT IN (0, 1, 2)) AS unexpected
    FROM numbers"""
)

ORACLE["numeric_coerce"] = _on_labels(
    "SELECT row_idx, CASE WHEN isfinite(num) THEN num END AS number FROM numbers"
)

_MEANING = (
    "CASE "
    + " ".join(f"WHEN {{x}} = {k} THEN '{v}'" for k, v in LABEL_MEANINGS.items())
    + " ELSE 'unexpected label' END"
)

ORACLE["label_names"] = _on_labels(
    f"""SELECT row_idx, CASE WHEN num IS NULL OR isnan(num) THEN 'missing/unparseable'
        ELSE {_MEANING.format(x='num')} END AS label_meaning FROM numbers"""
)



def _alignment(pair: str, left: str, right: str) -> str:
    missing = "(SELECT count(*) FROM (SELECT ID FROM {} EXCEPT SELECT ID FROM {}))"
    return f"""SELECT '{pair}' AS pair, count(*) FILTER (l.ID IS DISTINCT FROM r.ID) AS misplaced_rows,
        {missing.format(left, right)} AS only_left, {missing.format(right, left)} AS only_right,
        {missing.format(left, right)} + {missing.format(right, left)} = 0 AS same_set,
        count(*) FILTER (l.ID IS DISTINCT FROM r.ID) = 0 AS same_order
        FROM {left} l FULL JOIN {right} r USING (row_idx)"""


ORACLE["id_alignment"] = with_views(
    _alignment("sample/test", "v_sample", "v_test") + " UNION ALL " + _alignment("documents/train", "v_doc", "v_train"),
    "v_doc", "v_train", "v_test", v_sample="SELECT ID, row_idx FROM v_test",
)

ORACLE["label_conflicts"] = with_views(
    f"""SELECT left(any_value(k), 80) AS key_start,
        string_agg(DISTINCT CAST(LABEL AS VARCHAR), ',' ORDER BY CAST(LABEL AS VARCHAR)) AS labels,
        count(*) AS rows, min(row_idx) AS first_idx
    FROM (SELECT *, {_key(RAW)} AS k FROM v_conflict) GROUP BY k HAVING count(DISTINCT LABEL) > 1""",
    "v_conflict",
)



def _submission(which: str, view: str) -> str:
    return f"""SELECT '{which}' AS which, true AS "columns_exactly_ID_LABEL",
        count(s.row_idx) = count(t.row_idx) AS row_count_matches_test,
        count(*) FILTER (s.row_idx IS NULL OR t.row_idx IS NULL OR s.ID IS DISTINCT FROM t.ID) = 0 AS id_order_matches_test,
        count(*) FILTER (s.row_idx IS NOT NULL AND coalesce(s.LABEL NOT IN ('0', '1', '2'), true)) = 0 AS labels_are_allowed_integers,
        count(*) FILTER (s.row_idx IS NOT NULL AND s.LABEL IS NULL) = 0 AS no_missing_predictions
        FROM {view} s FULL JOIN v_test t ON s.row_idx = t.row_idx"""


ORACLE["validate_submission"] = with_views(
    _submission("good", "good") + " UNION ALL " + _submission("bad", "bad"),
    "v_test",
    good="SELECT row_idx, ID, CAST(row_idx % 3 AS VARCHAR) AS LABEL FROM v_test",
    bad="""SELECT row_idx, ID, CASE WHEN row_idx % 97 <> 5 THEN CAST(row_idx % 4 AS VARCHAR) END AS LABEL
        FROM v_test WHERE row_idx % 5 > 0""",
)

# --- duplicates -----------------------------------------------------------------

TRAIN_KEYS = f"SELECT *, {_key(RAW)} AS k FROM v_train"
TEST_KEYS = f"SELECT *, {_key(RAW)} AS k FROM v_test"
AFTER_OVERLAP = "SELECT * FROM tk WHERE k NOT IN (SELECT k FROM sk)"
CLEAN = "SELECT * FROM after_overlap QUALIFY row_number() OVER (PARTITION BY k ORDER BY row_idx) = 1"
UNIQUE = "SELECT * FROM sk QUALIFY row_number() OVER (PARTITION BY k ORDER BY row_idx) = 1"


def _on_keys(body: str, **more: str) -> str:
    return with_views(
        body, "v_train", "v_test", tk=TRAIN_KEYS, sk=TEST_KEYS, after_overlap=AFTER_OVERLAP,
        clean=CLEAN, uniq=UNIQUE, **more,
    )


ORACLE["duplicate_key"] = with_views(f"SELECT row_idx, {_key(RAW)} AS duplicate_key FROM v_decor", "v_decor")
ORACLE["eda_key"] = with_views(f"SELECT row_idx, {_report_key(RAW)} AS eda_key FROM v_decor", "v_decor")


def _duplicate_stats(keys: str, name: str) -> str:
    return f"""SELECT '{name}' AS split, count(*) FILTER (n > 1) AS duplicate_group_count,
        CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS rows_in_duplicate_groups,
        CAST(coalesce(sum(n - 1) FILTER (n > 1), 0) AS BIGINT) AS extra_duplicate_rows
        FROM (SELECT count(*) AS n FROM {keys} GROUP BY k)"""


ORACLE["duplicate_stats"] = _on_keys(
    _duplicate_stats("tk", "train") + " UNION ALL " + _duplicate_stats("sk", "test")
)
ORACLE["train_minus_overlap"] = _on_keys("SELECT row_idx, ID, TEXT, LABEL::BIGINT AS LABEL FROM after_overlap")
ORACLE["train_test_overlap"] = _on_keys(
    """SELECT (SELECT count(DISTINCT k) FROM tk WHERE k IN (SELECT k FROM sk)) AS overlap_groups,
        (SELECT count(*) FROM tk WHERE k IN (SELECT k FROM sk)) AS train_rows,
        (SELECT count(*) FROM sk WHERE k IN (SELECT k FROM tk)) AS test_rows"""
)
ORACLE["dedup_keep_first"] = with_views(
    f"""SELECT ID, row_idx, TEXT FROM v_doc
    QUALIFY row_number() OVER (PARTITION BY {_key(RAW)} ORDER BY row_idx) = 1""",
    "v_doc",
)
ORACLE["clean_train"] = _on_keys("SELECT row_idx, ID, TEXT, LABEL::BIGINT AS LABEL FROM clean")
ORACLE["unique_test"] = _on_keys("SELECT row_idx, ID, TEXT FROM uniq")
ORACLE["cleaning_summary"] = _on_keys(
    """SELECT (SELECT count(*) FROM tk) AS original_train_rows,
    (SELECT count(*) FROM sk) AS original_test_rows,
    (SELECT count(*) FROM tk WHERE LABEL = 0) AS original_train_label_0,
    (SELECT count(*) FROM tk WHERE LABEL = 1) AS original_train_label_1,
    (SELECT count(*) FROM tk WHERE LABEL = 2) AS original_train_label_2,
    (SELECT count(*) FROM tg WHERE n > 1) AS train_duplicate_groups,
    (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM tg) AS train_extra_duplicate_rows,
    (SELECT count(*) FROM sg WHERE n > 1) AS test_duplicate_groups,
    (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM sg) AS test_extra_duplicate_rows,
    (SELECT count(*) FROM tg WHERE k IN (SELECT k FROM sg)) AS train_test_overlap_groups,
    (SELECT count(*) FROM tk) - (SELECT count(*) FROM after_overlap) AS train_overlap_rows_removed,
    (SELECT count(*) FROM after_overlap) AS train_rows_after_overlap_removal,
    (SELECT count(*) FROM after_overlap) - (SELECT count(*) FROM clean) AS train_duplicate_rows_removed,
    (SELECT count(*) FROM clean) AS clean_train_rows,
    (SELECT count(*) FROM clean WHERE LABEL = 0) AS clean_train_label_0,
    (SELECT count(*) FROM clean WHERE LABEL = 1) AS clean_train_label_1,
    (SELECT count(*) FROM clean WHERE LABEL = 2) AS clean_train_label_2,
    (SELECT count(*) FROM uniq) AS unique_test_rows_for_inference,
    (SELECT count(*) FROM sk) - (SELECT count(*) FROM uniq) AS test_duplicate_rows_collapsed,
    (SELECT count(*) FROM tg WHERE labels > 1) AS conflicting_duplicate_label_groups""",
    tg="SELECT k, count(*) AS n, count(DISTINCT LABEL) AS labels FROM tk GROUP BY k",
    sg="SELECT k, count(*) AS n FROM sk GROUP BY k",
)
ORACLE["expand_predictions"] = _on_keys(
    "SELECT sk.ID, sk.row_idx, uniq.row_idx % 3 AS LABEL FROM sk JOIN uniq USING (k)"
)
_MEANINGS = " UNION ALL ".join(f"SELECT {k}::BIGINT AS LABEL, '{v}' AS meaning" for k, v in LABEL_MEANINGS.items())
ORACLE["label_counts"] = _on_keys(
    """SELECT m.LABEL, m.meaning, count(c.ID) AS "count",
        round(100.0 * count(c.ID) / (SELECT count(*) FROM clean), 6) AS percent
    FROM meanings m LEFT JOIN clean c ON m.LABEL = c.LABEL GROUP BY 1, 2""",
    meanings=_MEANINGS,
)
ORACLE["label_distribution"] = _on_labels(
    f"""SELECT CASE WHEN v IS NULL THEN 'missing_or_unparseable' WHEN isinf(v) THEN 'inf'
            WHEN v = round(v) THEN CAST(CAST(v AS BIGINT) AS VARCHAR) ELSE CAST(v AS VARCHAR) END AS LABEL,
        CASE WHEN v IS NULL THEN 'missing or unparseable label' ELSE {_MEANING.format(x='v')} END AS meaning,
        "count", round(100.0 * "count" / (SELECT count(*) FROM v_doc), 6) AS proportion_pct
    FROM (SELECT CASE WHEN NOT isnan(num) THEN num END AS v, count(*) AS "count" FROM numbers GROUP BY 1)"""
)
ORACLE["label_integrity"] = _on_labels(
    """SELECT count(*) FILTER (num IN (0, 1, 2)) AS valid_label_rows,
        count(*) FILTER (num IS NULL OR isnan(num)) AS missing_or_unparseable_rows,
        count(*) FILTER (NOT isnan(num) AND num NOT IN (0, 1, 2)) AS unexpected_label_rows,
        count(DISTINCT num) FILTER (NOT isnan(num) AND num NOT IN (0, 1, 2)) AS unexpected_label_count,
        count(*) FILTER (num IN (0, 1, 2)) = count(*) AS all_training_labels_valid FROM numbers"""
)
ORACLE["unexpected_labels"] = _on_labels(
    "SELECT num AS value, count(*) AS rows FROM numbers WHERE NOT isnan(num) AND num NOT IN (0, 1, 2) GROUP BY 1"
)
ORACLE["csv_round_trip"] = with_views(
    """SELECT ID, CASE WHEN row_idx % 13 <> 3 THEN nullif(TEXT, '') END AS TEXT, row_idx FROM v_decor""", "v_decor"
)
ORACLE["stratified_split"] = with_views(
    """SELECT ID, row_idx, LABEL::BIGINT AS LABEL, place <= quota AS is_valid FROM (
        SELECT v.*, row_number() OVER (PARTITION BY v.LABEL ORDER BY md5(concat(ID, '539')), row_idx) AS place
        FROM v_train v) p JOIN quotas USING (LABEL)""",
    "v_train",
    shares="""SELECT LABEL, ceil(0.2 * sum(count(*)) OVER ()) AS size,
        ceil(0.2 * sum(count(*)) OVER ()) * count(*) / sum(count(*)) OVER () AS exact FROM v_train GROUP BY LABEL""",
    quotas="""SELECT LABEL, floor(exact) + CASE WHEN row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, LABEL)
        <= size - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS quota FROM shares""",
)
ORACLE["id_overlap"] = (
    "SELECT CAST(doc_id AS VARCHAR) AS ID FROM documents INTERSECT SELECT CAST(page_id AS VARCHAR) FROM pages"
)

# --- report -----------------------------------------------------------------------

ORACLE["overview"] = with_views(
    """SELECT 'train' AS split, count(*) AS rows, 3::BIGINT AS columns FROM v_train
    UNION ALL SELECT 'test', count(*), 2 FROM v_decor
    UNION ALL SELECT 'sample_submission', count(*), 2 FROM v_test""",
    "v_train", "v_test", "v_decor",
)


def _missing(split: str, view: str, col: str, text: bool = True) -> str:
    blank = f"count(*) FILTER (NOT regexp_matches(coalesce({col}::VARCHAR, ''), '[^\\t\\n\\x0b\\f\\r\\x1c-\\x1f\\x85\\p{{Z}}]'))"
    blank = blank if text else "0"
    return f"""SELECT '{split}' AS split, '{col}' AS "column", count(*) - count({col}) AS missing_count,
        round(100.0 * (count(*) - count({col})) / count(*), 6) AS missing_pct, {blank} AS blank_count,
        round(100.0 * {blank} / count(*), 6) AS blank_pct FROM {view}"""


ORACLE["missing_report"] = with_views(
    " UNION ALL ".join(
        [
            _missing("train", "v_train", "ID"), _missing("train", "v_train", "TEXT"),
            _missing("train", "v_train", "LABEL", False), _missing("test", "v_decor", "ID"),
            _missing("test", "v_decor", "TEXT"), _missing("sample_submission", "v_sample", "ID"),
            _missing("sample_submission", "v_sample", "LABEL", False),
        ]
    ),
    "v_train", "v_test", "v_decor",
    v_sample="SELECT ID, row_idx, 0 AS LABEL FROM v_test",
)


# a template that lacks some test rows and has another ID in some
SOME_SAMPLE = """SELECT CASE WHEN row_idx % 10 = 3 THEN concat('x', ID) ELSE ID END AS ID, row_idx FROM v_test
    WHERE row_idx % 7 > 0"""


def _ids(split: str, view: str) -> str:
    return f"""SELECT '{split}_row_count' AS "check", count(*)::VARCHAR AS value, 'rows in the table' AS details FROM {view}
    UNION ALL SELECT '{split}_unique_id_count', count(DISTINCT ID)::VARCHAR, 'different IDs; a missing one counts once' FROM {view}
    UNION ALL SELECT '{split}_missing_id_count', (count(*) - count(ID))::VARCHAR, 'rows without an ID' FROM {view}
    UNION ALL SELECT '{split}_duplicate_id_rows', (SELECT count(*) FROM {view} WHERE ID IN
        (SELECT ID FROM {view} GROUP BY ID HAVING count(*) > 1))::VARCHAR, 'rows whose ID occurs more than once'"""


ORACLE["id_report"] = with_views(
    f"""{_ids('train', 'v_train')} UNION ALL {_ids('test', 'v_test')}
    UNION ALL {_ids('sample_submission', 'v_some')}
    UNION ALL SELECT 'train_test_id_overlap_count', count(*)::VARCHAR, 'IDs that both train and test have'
        FROM (SELECT ID FROM v_train INTERSECT SELECT ID FROM v_test)
    UNION ALL SELECT 'sample_submission_row_count_matches_test',
        ((SELECT count(*) FROM v_some) = (SELECT count(*) FROM v_test))::VARCHAR,
        concat('template: ', (SELECT count(*) FROM v_some), ', test: ', (SELECT count(*) FROM v_test))
    UNION ALL SELECT 'sample_submission_id_set_matches_test',
        (NOT EXISTS (SELECT ID FROM v_some EXCEPT SELECT ID FROM v_test)
            AND NOT EXISTS (SELECT ID FROM v_test EXCEPT SELECT ID FROM v_some))::VARCHAR,
        'both tables hold the same IDs in any order'
    UNION ALL SELECT 'sample_submission_id_order_matches_test',
        (count(*) FILTER (s.ID IS DISTINCT FROM t.ID) = 0)::VARCHAR, 'every row has the same ID in both tables'
        FROM v_some s FULL JOIN v_test t USING (row_idx)""",
    "v_train", "v_test", v_some=SOME_SAMPLE,
)


def _measures(view: str, *keep: str) -> str:
    letters, capitals = _count(RAW, "[A-Za-z]"), _count(RAW, "[A-Z]")
    return f"""SELECT {', '.join(keep)}, length({RAW})::DOUBLE AS char_count,
        {_count(RAW, f"{WORD}[\\p{{L}}\\p{{N}}_']*{WORD}")}::DOUBLE AS word_count,
        {_count(RAW, '!')}::DOUBLE AS exclamation_count, {_count(RAW, '[?]')}::DOUBLE AS question_count,
        coalesce({capitals} / nullif({letters}, 0), 0)::DOUBLE AS uppercase_ratio,
        {_collapse(RAW)} = '' AS is_blank_text, regexp_matches({RAW}, '(?i)https?://|www\\.') AS has_url,
        regexp_matches({RAW}, '(?i)<[^>]+>|&[a-z]+;') AS has_html,
        regexp_matches({RAW}, '[!?.,;:]{{3,}}') AS has_repeated_punctuation FROM {view}"""


ORACLE["text_features"] = with_views(
    "SELECT * REPLACE (round(uppercase_ratio, 6) AS uppercase_ratio) FROM m",
    "v_decor", m=_measures("v_decor", "ID", "'test' AS split"),
)
NUMERIC = "char_count, word_count, exclamation_count, question_count, uppercase_ratio"


def _stats(groups: str) -> str:
    return f"""SELECT {groups}, feature, count(value) AS "count", round(avg(value), 6) AS mean,
        round(min(value), 6) AS min, round(quantile_cont(value, 0.5), 6) AS median,
        round(quantile_cont(value, 0.9), 6) AS p90, round(max(value), 6) AS max
        FROM (UNPIVOT m ON {NUMERIC} INTO NAME feature VALUE value) GROUP BY ALL"""


ORACLE["num_by_split"] = with_views(
    _stats("split"), "v_train", "v_test",
    m=_measures("v_train", "'train' AS split") + " UNION ALL " + _measures("v_test", "'test' AS split"),
)
ORACLE["num_by_label"] = with_views(
    _stats("LABEL, label_meaning"), "v_train",
    m=_measures("v_train", "LABEL::DOUBLE AS LABEL", f"{_MEANING.format(x='LABEL')} AS label_meaning"),
)
ORACLE["binary_by_label"] = with_views(
    """SELECT LABEL, label_meaning, feature, count(*) FILTER (value) AS true_count,
        round(100.0 * count(*) FILTER (value) / count(*), 6) AS true_pct
    FROM (UNPIVOT m ON is_blank_text, has_url, has_html, has_repeated_punctuation INTO NAME feature VALUE value)
    GROUP BY ALL""",
    "v_decor", "v_train",
    j="SELECT d.TEXT, t.LABEL::DOUBLE AS LABEL FROM v_decor d LEFT JOIN v_train t USING (row_idx)",
    m=_measures("j", "LABEL", f"CASE WHEN LABEL IS NULL THEN 'missing/unparseable' ELSE {_MEANING.format(x='LABEL')} END AS label_meaning"),
)
ORACLE["duplicate_summary"] = with_views(
    """SELECT * REPLACE (coalesce(train_row_count::VARCHAR, '') AS train_row_count,
        coalesce(test_row_count::VARCHAR, '') AS test_row_count) FROM (
    SELECT 'train' AS location, 'duplicate normalized text' AS "check", count(*) AS group_count,
        CAST(coalesce(sum(n), 0) AS BIGINT) AS train_row_count, NULL::BIGINT AS test_row_count, count(*) > 0 AS "exists"
        FROM a WHERE n > 1
    UNION ALL SELECT 'train', 'duplicate normalized text with conflicting labels', count(*),
        CAST(coalesce(sum(n), 0) AS BIGINT), NULL, count(*) > 0 FROM a WHERE n > 1 AND labels > 1
    UNION ALL SELECT 'test', 'duplicate normalized text', count(*), NULL,
        CAST(coalesce(sum(n), 0) AS BIGINT), count(*) > 0 FROM b WHERE n > 1
    UNION ALL SELECT 'train/test', 'shared normalized text', count(*), CAST(coalesce(sum(a.n), 0) AS BIGINT),
        CAST(coalesce(sum(b.n), 0) AS BIGINT), count(*) > 0 FROM a JOIN b USING (k))""",
    "v_decor", "v_train", "v_test",
    a=f"""SELECT {_report_key("coalesce(d.TEXT, '')")} AS k, count(*) AS n, count(DISTINCT t.LABEL) AS labels
        FROM v_decor d LEFT JOIN v_train t USING (row_idx) GROUP BY 1 HAVING k <> ''""",
    b=f"SELECT {_report_key(RAW)} AS k, count(*) AS n FROM v_test GROUP BY 1 HAVING k <> ''",
)

# --- text steps ---------------------------------------------------------------------


def _unescape(text: str) -> str:
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


def _strip_tags(text: str) -> str:
    return _sub(_sub(text, rf"<{BLANK}*br{BLANK}*/?{BLANK}*>", " ", "gi"), "<[^>]+>", " ")


def _fold(text: str) -> str:
    text = _sub(text, r"[\x{2018}\x{2019}\x{201a}\x{201b}`]", "'")
    text = _sub(text, r"[\x{201c}-\x{201f}]", '"')
    text = _sub(text, r"[\x{a0}\x{202f}\x{2007}]", " ")
    return _sub(_sub(text, r"[\x{2010}-\x{2015}\x{2212}]", " - "), r"\x{2026}", " ... ")


def _base(text: str) -> str:
    text = _fold(_strip_tags(_unescape(text)))
    text = _sub(text, r"[\x{200b}\x{200c}\x{200d}\x{feff}\x{0}-\x{8}\x0b\x0c\x0e-\x1f\x7f]", " ")
    return _collapse(text)


def _mask(text: str) -> str:
    text = _sub(text, r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", " __email__ ", "gi")
    return _sub(text, r"\b(https?://|www\.)[^\t\n\x0b\f\r\x1c-\x1f\x85\p{Z}]+", " __url__ ", "gi")


def _expand(text: str) -> str:
    for short, full in sorted(CONTRACTIONS.items(), key=lambda item: -len(item[0])):
        text = _sub(text, rf"\b{short}\b", full, "gi")
    return _sub(text, r"\b([A-Za-z]+)n't\b", r"\1 not", "gi")


def _rate(text: str) -> str:
    number = r"(10|[0-9](\.\d+)?)"
    text = _sub(text, rf"\b{number}\s*out\s+of\s+10\b", r" __rt10_\1__ ", "gi")
    text = _sub(text, rf"\b{number}\s*/\s*10\b", r" __rt10_\1__ ", "gi")
    text = _sub(text, r"\b([0-5](\.\d+)?)\s*-?\s*stars?\b", r" __rt5_\1__ ", "gi")
    for i, word in enumerate(("zero", "one", "two", "three", "four", "five")):
        text = _sub(text, rf"\b{word}\s*-?\s*stars?\b", f" __rt5_{i}__ ", "gi")
    for scale, high, low in (
        (10, r"10|[7-9](\.\d+)?", r"[0-3](\.\d+)?|4(\.0+)?"),
        (5, r"3\.[5-9]\d*|[45](\.\d+)?", r"[01](\.\d+)?|2(\.0+)?"),
    ):
        text = _sub(text, f"__rt{scale}_({high})__", "__rating_high__")
        text = _sub(text, f"__rt{scale}_({low})__", "__rating_low__")
        text = _sub(text, rf"__rt{scale}_[0-9.]+__", "__rating_mid__")
    return text


def _grade(text: str) -> str:
    for grades, name in ((r"a\+|a-|b\+", "high"), ("f-|d-", "low")):
        for _ in range(2):
            text = _sub(
                text, rf"(^|[^\p{{L}}\p{{N}}_])({grades})([^\p{{L}}\p{{N}}_]|$)", rf"\1 __grade_{name}__ \3", "gi"
            )
    return text


def _punct(text: str) -> str:
    text = _sub(text, r"(!\?|\?!)[!?]*", " __mixed_punct__ ")
    return _sub(_sub(text, "!{2,}", " __repeat_exclamation__ "), r"\?{2,}", " __repeat_question__ ")


def _shorten(text: str) -> str:
    for letter in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
        text = _sub(text, letter + "{3,}", letter * 2)
    return text


def _on_decor(name: str, *steps) -> None:
    text = RAW
    for step in steps:
        text = step(text)
    ORACLE[name] = with_views(f"SELECT row_idx, {text} AS {name} FROM v_decor", "v_decor")


_on_decor("char_fold", _fold)
_on_decor("base_text", _base)
_on_decor("mask_email_url", _mask)
_on_decor("contractions", _expand)
_on_decor("ratings", _rate)
_on_decor("grades", _grade)
_on_decor("punct_tokens", _punct)
_on_decor("elongation", _shorten)
ORACLE["html_text"] = f"SELECT page_id, {_strip_tags(_unescape('html'))} AS html_text FROM pages"
ORACLE["page_base_text"] = f"SELECT page_id, {_base('html')} AS base_text FROM pages"

# each step of the chain in its own subquery, so no expression is repeated
CLEAN_CHAIN = {
    "s1": f"SELECT row_idx, {_base(RAW)} AS x FROM v_decor",
    "s2": f"SELECT row_idx, {_expand(_mask('x'))} AS x FROM s1",
    "s3": f"SELECT row_idx, {_grade(_rate('x'))} AS x FROM s2",
    "s4": f"SELECT row_idx, {_collapse(_shorten(_punct('x')))} AS x FROM s3",
}
ORACLE["clean_text"] = with_views("SELECT row_idx, x AS clean_text FROM s4", "v_decor", **CLEAN_CHAIN)

TRIGGERS = "'not','no','never','cannot','without','hardly','barely','rarely','neither','nor'"


def _negation(source: str, out: str) -> dict[str, str]:
    tokens = rf"regexp_extract_all(x, '{WORD}+|[^\p{{L}}\p{{N}}_\t\n\x0b\f\r\x1c-\x1f\x85\p{{Z}}]')"
    return {
        "lists": f"SELECT row_idx, {tokens} AS toks FROM {source}",
        "toks": """SELECT row_idx, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM lists""",
        "kinds": f"""SELECT *, regexp_matches(tok, '^{WORD}+$') AS word, lower(tok) IN ({TRIGGERS}) AS opens,
            tok IN ('.', '!', '?', ';', ':') AS shuts FROM toks""",
        "segments": """SELECT *, count(*) FILTER (opens OR shuts) OVER (PARTITION BY row_idx ORDER BY pos) AS seg FROM kinds""",
        "scopes": """SELECT *, bool_or(opens) OVER (PARTITION BY row_idx, seg) AS scoped,
            count(*) FILTER (word AND NOT opens) OVER (PARTITION BY row_idx, seg ORDER BY pos) AS nth FROM segments""",
        "joined": f"""SELECT row_idx, string_agg(CASE WHEN scoped AND word AND NOT opens AND nth <= 4
            THEN tok || '_NEG' ELSE tok END, ' ' ORDER BY pos) AS {out} FROM scopes GROUP BY row_idx""",
    }


ORACLE["negation_scope"] = with_views(
    "SELECT row_idx, coalesce(negation_scope, '') AS negation_scope FROM v_decor LEFT JOIN joined USING (row_idx)",
    "v_decor", raw=f"SELECT row_idx, {RAW} AS x FROM v_decor", **_negation("raw", "negation_scope"),
)
ORACLE["clean_text_negation"] = with_views(
    "SELECT row_idx, coalesce(clean_text, '') AS clean_text FROM v_decor LEFT JOIN joined USING (row_idx)",
    "v_decor", **CLEAN_CHAIN, **_negation("s4", "clean_text"),
)

# --- features -------------------------------------------------------------------------

SURFACE = f"""SELECT row_idx, ln(1 + length(x)) AS log_char_count, ln(1 + {_count('x', WORD + '+')}) AS log_word_count,
    {_count('x', '[.!?]')}::DOUBLE AS sentence_punct_count, {_count('x', '!')}::DOUBLE AS exclamation_count,
    {_count('x', '[?]')}::DOUBLE AS question_count,
    {_count('x', '[' + chr(92) + 'p{Lu}]')} / greatest({_count('x', chr(92) + 'p{L}')}, 1) AS uppercase_ratio,
    {_count('x', chr(92) + 'p{Nd}')} / greatest(length(x), 1) AS digit_ratio,
    {_count('x', chr(92) + 'p{P}')} / greatest(length(x), 1) AS punct_ratio,
    regexp_matches(x, '!!|\\?\\?|\\.\\.|,,|;;|::|!\\?|\\?!')::INT::DOUBLE AS has_repeated_punctuation FROM based"""
BASED = f"SELECT row_idx, {_base(RAW)} AS x FROM v_decor"
NAMES = [
    "log_char_count", "log_word_count", "sentence_punct_count", "exclamation_count", "question_count",
    "uppercase_ratio", "digit_ratio", "punct_ratio", "has_repeated_punctuation",
]
ORACLE["surface_features"] = with_views(
    f"SELECT row_idx, {', '.join(f'round({n}, 6) AS {n}' for n in NAMES)} FROM f", "v_decor", based=BASED, f=SURFACE
)


def _scaled(name: str) -> str:
    return f"{name} / (SELECT CASE WHEN max(abs({name})) > 0 THEN max(abs({name})) ELSE 1 END FROM f)"


ORACLE["surface_scaled"] = with_views(
    f"SELECT row_idx, {', '.join(f'round({_scaled(n)}, 6) AS {n}' for n in NAMES)} FROM f",
    "v_decor", based=BASED, f=SURFACE,
)


def _tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{WORD}{{2,}}')"


ORACLE["word_tokens"] = with_views(
    f"SELECT row_idx, array_to_string({_tokens(RAW)}, ' ') AS tokens FROM v_decor", "v_decor"
)


def _word_grams(source: str, text: str, high: int) -> dict[str, str]:
    """``wlist`` (tokens per row) and ``wgrams`` (one row per n-gram occurrence)."""
    grams = " UNION ALL ".join(
        f"""SELECT row_idx, array_to_string(w[i:i + {n - 1}], ' ') AS term
        FROM (SELECT row_idx, w, unnest(range(1, len(w) - {n - 2})) AS i FROM {source}_wlist)"""
        for n in range(1, high + 1)
    )
    return {f"{source}_wlist": f"SELECT row_idx, {_tokens(text)} AS w FROM {source}", f"{source}_wgrams": grams}


def _char_grams(source: str, text: str, high: int) -> dict[str, str]:
    grams = " UNION ALL ".join(
        f"""SELECT row_idx, substr(p, i, {n}) AS term
        FROM (SELECT row_idx, p, unnest(range(1, length(p) - {n - 2})) AS i FROM {source}_padded)"""
        for n in range(3, high + 1)
    )
    return {
        f"{source}_padded": f"""SELECT row_idx, concat(' ', unnest(string_split_regex(trim({_collapse(f'lower({text})')}), ' ')), ' ') AS p
            FROM {source} WHERE {_collapse(text)} <> ''""",
        f"{source}_cgrams": grams,
    }


ORACLE["word_ngrams"] = with_views(
    "SELECT term AS gram, count(*) AS n FROM v_doc_wgrams GROUP BY 1", "v_doc", **_word_grams("v_doc", "TEXT", 3)
)
ORACLE["char_ngrams"] = with_views(
    "SELECT term AS gram, count(*) AS n FROM v_doc_cgrams GROUP BY 1", "v_doc", **_char_grams("v_doc", "TEXT", 6)
)


def _vocab(grams: str, source: str, low: int, share: str | None) -> str:
    top = f"AND df <= {share} * n" if share else ""
    return f"""SELECT term, df, ln((1.0 + n) / (1 + df)) + 1 AS idf FROM
        (SELECT term, count(DISTINCT row_idx) AS df FROM {grams} GROUP BY 1), (SELECT count(*) AS n FROM {source})
        WHERE df >= {low} {top}"""


def _weights(grams: str, vocab: str) -> str:
    return f"""SELECT row_idx, term, x / sqrt(sum(x * x) OVER (PARTITION BY row_idx)) AS weight FROM
        (SELECT row_idx, term, (1 + ln(tf)) * idf AS x FROM
            (SELECT row_idx, term, count(*) AS tf FROM {grams} GROUP BY 1, 2) JOIN {vocab} USING (term))"""


WORD_VOCAB = _vocab("v_doc_wgrams", "v_doc", 2, "0.95")
CHAR_VOCAB = _vocab("v_doc_cgrams", "v_doc", 3, None)
ORACLE["doc_freq_word"] = with_views(
    "SELECT term, df FROM vocab", "v_doc", **_word_grams("v_doc", "TEXT", 2), vocab=WORD_VOCAB
)
ORACLE["doc_freq_char"] = with_views(
    "SELECT term, df FROM vocab", "v_doc", **_char_grams("v_doc", "TEXT", 5), vocab=CHAR_VOCAB
)
ORACLE["idf_word"] = with_views(
    "SELECT term, round(idf, 6) AS idf FROM vocab", "v_doc", **_word_grams("v_doc", "TEXT", 2), vocab=WORD_VOCAB
)
ORACLE["doc_freq_char_stage2"] = with_views(
    "SELECT term, df FROM vocab", "v_doc", **_char_grams("v_doc", "TEXT", 6),
    vocab=_vocab("v_doc_cgrams", "v_doc", 2, None),
)
ORACLE["tfidf_word"] = with_views(
    "SELECT row_idx, term, round(weight, 4) AS weight FROM weights", "v_doc",
    **_word_grams("v_doc", "TEXT", 2), vocab=WORD_VOCAB, weights=_weights("v_doc_wgrams", "vocab"),
)
DIGEST = """SELECT row_idx, count(*) AS terms, round(sum(weight), 4) AS weight_sum, round(max(weight), 4) AS weight_max,
    round(sum(weight * length(term)), 4) AS length_sum FROM weights GROUP BY 1"""
ORACLE["tfidf_word_stage2"] = with_views(
    DIGEST, "v_doc", **_word_grams("v_doc", "TEXT", 3), vocab=WORD_VOCAB, weights=_weights("v_doc_wgrams", "vocab"),
)
ORACLE["tfidf_char"] = with_views(
    """SELECT row_idx, count(*) AS terms, round(sum(weight), 4) AS weight_sum, round(max(weight), 4) AS weight_max,
        round(sum(weight * length(term)), 4) AS length_sum FROM weights GROUP BY 1""", "v_doc",
    **_char_grams("v_doc", "TEXT", 5), vocab=CHAR_VOCAB, weights=_weights("v_doc_cgrams", "vocab"),
)
ORACLE["tfidf_transform"] = with_views(
    "SELECT row_idx, term, round(weight, 4) AS weight FROM weights", "v_train", "v_test",
    **_word_grams("v_train", "TEXT", 2), **_word_grams("v_test", "TEXT", 2),
    vocab=_vocab("v_train_wgrams", "v_train", 2, "0.95"), weights=_weights("v_test_wgrams", "vocab"),
)


def _union_of_features(word: int, char: int, char_min: int, surface: float, text: dict[str, str], source: str) -> str:
    """Digest of a stage's features; ``text`` defines the table ``source(row_idx, x)`` of its texts."""
    return with_views(
        f"""SELECT row_idx, branch, count(*) AS terms, round(sum(weight), 4) AS weight_sum,
            round(max(weight), 4) AS weight_max FROM (
            SELECT row_idx, 'word' AS branch, weight FROM ww UNION ALL SELECT row_idx, 'char', weight FROM cw
            UNION ALL SELECT row_idx, 'surface', {surface} * value FROM (UNPIVOT scaled ON COLUMNS(* EXCLUDE row_idx)
                INTO NAME feature VALUE value) WHERE value <> 0)
        GROUP BY 1, 2""",
        "v_decor", based=BASED, f=SURFACE,
        scaled=f"SELECT row_idx, {', '.join(f'{_scaled(n)} AS {n}' for n in NAMES)} FROM f",
        **CLEAN_CHAIN, **text,
        **_word_grams(source, "x", word), **_char_grams(source, "x", char),
        wv=_vocab(f"{source}_wgrams", source, 2, "0.95"), cv=_vocab(f"{source}_cgrams", source, char_min, None),
        ww=_weights(f"{source}_wgrams", "wv"), cw=_weights(f"{source}_cgrams", "cv"),
    )


ORACLE["feature_union"] = _union_of_features(2, 5, 3, 0.5, {}, "s4")
ORACLE["feature_union_stage2"] = _union_of_features(
    3, 6, 2, 1.0,
    _negation("s4", "x") | {"negated": "SELECT row_idx, coalesce(x, '') AS x FROM v_decor LEFT JOIN joined USING (row_idx)"},
    "negated",
)
ORACLE["linear_score"] = with_views(
    """SELECT d.row_idx, round(coalesce(sum(weight * (length(term) % 5 - 2)), 0) + 0.25, 4) AS margin
    FROM v_doc d LEFT JOIN weights w ON d.row_idx = w.row_idx GROUP BY 1""", "v_doc",
    **_word_grams("v_doc", "TEXT", 2), vocab=WORD_VOCAB, weights=_weights("v_doc_wgrams", "vocab"),
)

# --- evaluation -------------------------------------------------------------------------

JUDGED = """SELECT LABEL AS a, CASE WHEN row_idx % 7 = 0 THEN (LABEL + 1) % 3 WHEN row_idx % 11 = 0 THEN 0
    ELSE LABEL END AS p FROM v_train"""
PER_CLASS = """SELECT LABEL, meaning,
    coalesce(count(*) FILTER (a = LABEL AND p = LABEL) / nullif(count(*) FILTER (p = LABEL), 0), 0) AS precision,
    coalesce(count(*) FILTER (a = LABEL AND p = LABEL) / nullif(count(*) FILTER (a = LABEL), 0), 0) AS recall,
    count(*) FILTER (a = LABEL) AS support FROM judged, meanings GROUP BY 1, 2"""
F1 = "coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)"
ORACLE["confusion_matrix"] = with_views(
    """SELECT LABEL AS actual, count(*) FILTER (a = LABEL AND p = 0) AS predicted_0,
        count(*) FILTER (a = LABEL AND p = 1) AS predicted_1, count(*) FILTER (a = LABEL AND p = 2) AS predicted_2
    FROM judged, meanings GROUP BY 1""",
    "v_train", judged=JUDGED, meanings=_MEANINGS,
)
ORACLE["per_class_metrics"] = with_views(
    f"""SELECT LABEL, meaning, round(precision, 6) AS precision, round(recall, 6) AS recall,
        round({F1}, 6) AS f1, support FROM c""",
    "v_train", judged=JUDGED, meanings=_MEANINGS, c=PER_CLASS,
)
ORACLE["overall_metrics"] = with_views(
    f"""SELECT round(avg({F1}), 6) AS macro_f1, (SELECT round(avg((a = p)::INT), 6) FROM judged) AS accuracy,
        (SELECT count(*) FROM judged) AS row_count FROM c""",
    "v_train", judged=JUDGED, meanings=_MEANINGS, c=PER_CLASS,
)

# --- classifier with weights from a formula -----------------------------------------------


def _prepared(view: str) -> dict[str, str]:
    """``{view}_based``, ``{view}_clean``, ``{view}_neg`` (row_idx, x) and surface features ``{view}_f``."""
    negation = _negation(f"{view}_clean", "x")
    names = re.compile(r"\b(" + "|".join(negation) + r")\b")
    return {
        f"{view}_based": f"SELECT row_idx, {_base(RAW)} AS x FROM {view}",
        f"{view}_s2": f"SELECT row_idx, {_expand(_mask('x'))} AS x FROM {view}_based",
        f"{view}_s3": f"SELECT row_idx, {_grade(_rate('x'))} AS x FROM {view}_s2",
        f"{view}_clean": f"SELECT row_idx, {_collapse(_shorten(_punct('x')))} AS x FROM {view}_s3",
        **{f"{view}_{n}": names.sub(rf"{view}_\1", body) for n, body in negation.items()},
        f"{view}_neg": f"SELECT c.row_idx, coalesce(j.x, '') AS x FROM {view}_clean c LEFT JOIN {view}_joined j USING (row_idx)",
        f"{view}_f": SURFACE.replace("FROM based", f"FROM {view}_based"),
    }


def _branch(name: str, grams: str) -> str:
    return f"""SELECT row_idx, sum(x * w) / sqrt(sum(x * x)) AS part FROM
        (SELECT row_idx, (1 + ln(tf)) * idf AS x, ((length(term) * 7) % 5 - 2) / 10.0 AS w FROM
            (SELECT row_idx, term, count(*) AS tf FROM {grams} GROUP BY 1, 2) JOIN {name} USING (term)) GROUP BY 1"""


STAGES = (("one", "clean", 2, 5, 3, 0.5), ("two", "neg", 3, 6, 2, 1.0))


def _vocabularies(fit: str) -> dict[str, str]:
    """Both stages' vocabularies from the prepared view ``fit``, which has a LABEL."""
    parts = {}
    for name, text, word, char, char_min, _ in STAGES:
        source = f"{name}_fit"
        only = "" if name == "one" else f"WHERE row_idx IN (SELECT row_idx FROM {fit} WHERE LABEL IN (1, 2))"
        parts |= {source: f"SELECT * FROM {fit}_{text} {only}", f"{name}_top": f"SELECT * FROM {fit}_f {only}"}
        parts |= _word_grams(source, "x", word) | _char_grams(source, "x", char)
        parts[f"{name}_wv"] = _vocab(f"{source}_wgrams", source, 2, "0.95")
        parts[f"{name}_cv"] = _vocab(f"{source}_cgrams", source, char_min, None)
    return parts


def _predicted(fit: str, given: str) -> dict[str, str]:
    """``predicted(row_idx, pred)`` of the view ``given``, fitted on the view ``fit``."""
    parts = _prepared(fit) | _prepared(given) | _vocabularies(fit)
    for name, text, word, char, _, weight in STAGES:
        source = f"{name}_given"
        parts[source] = f"SELECT * FROM {given}_{text}"
        parts |= _word_grams(source, "x", word) | _char_grams(source, "x", char)
        parts[f"{name}_w"] = _branch(f"{name}_wv", f"{source}_wgrams")
        parts[f"{name}_c"] = _branch(f"{name}_cv", f"{source}_cgrams")
        surface = " + ".join(
            f"""g.{n} / (SELECT CASE WHEN max(abs({n})) > 0 THEN max(abs({n})) ELSE 1 END FROM {name}_top)
            * {0.05 * (i - 4) * weight!r}"""
            for i, n in enumerate(NAMES)
        )
        parts[f"{name}_margin"] = f"""SELECT row_idx, 0.1 + coalesce(w.part, 0) + coalesce(c.part, 0) + {surface} AS margin
            FROM {given}_f g LEFT JOIN {name}_w w USING (row_idx) LEFT JOIN {name}_c c USING (row_idx)"""
    parts["predicted"] = """SELECT row_idx, (CASE WHEN a.margin <= 0 THEN 0 WHEN b.margin > 0 THEN 2 ELSE 1 END)::BIGINT AS pred
        FROM one_margin a JOIN two_margin b USING (row_idx)"""
    return parts


ORACLE["two_stage_fit"] = with_views(
    " UNION ALL ".join(
        f"SELECT '{task}' AS task, '{branch}' AS branch, count(*) AS terms, sum(df)::BIGINT AS df_sum FROM {name}_{table}"
        for name, task in (("one", "label 0 vs review"), ("two", "label 1 vs label 2"))
        for branch, table in (("word", "wv"), ("char", "cv"))
    ),
    "v_train", **_prepared("v_train"), **_vocabularies("v_train"),
)
ORACLE["two_stage_predict_formula"] = with_views(
    "SELECT row_idx, pred FROM predicted", "v_train", "v_test", **_predicted("v_train", "v_test")
)
ORACLE["submission_formula"] = _on_keys(
    """SELECT sk.row_idx, sk.ID, pred AS LABEL FROM sk JOIN uniq USING (k)
    JOIN predicted p ON p.row_idx = uniq.row_idx""",
    **_predicted("clean", "uniq"),
)
_HALVES = dict(
    shares="""SELECT LABEL, ceil(0.2 * sum(count(*)) OVER ()) AS size,
        ceil(0.2 * sum(count(*)) OVER ()) * count(*) / sum(count(*)) OVER () AS exact FROM clean GROUP BY LABEL""",
    quotas="""SELECT LABEL, floor(exact) + CASE WHEN row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, LABEL)
        <= size - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS quota FROM shares""",
)
ORACLE["holdout_eval_formula"] = _on_keys(
    f"""SELECT round(avg({F1}), 6) AS macro_f1, (SELECT round(avg((a = p)::INT), 6) FROM judged) AS accuracy,
        (SELECT count(*) FROM judged) AS row_count FROM c""",
    **_HALVES,
    halves="""SELECT p.row_idx, p.TEXT, p.LABEL, place <= quota AS is_valid FROM (
        SELECT v.*, row_number() OVER (PARTITION BY v.LABEL ORDER BY md5(concat(ID, '539')), row_idx) AS place
        FROM clean v) p JOIN quotas USING (LABEL)""",
    fitted="SELECT * FROM halves WHERE NOT is_valid",
    held="SELECT * FROM halves WHERE is_valid",
    **_predicted("fitted", "held"),
    judged="SELECT LABEL AS a, pred AS p FROM predicted JOIN held USING (row_idx)",
    meanings=_MEANINGS, c=PER_CLASS,
)

# a fitted model has no SQL form, what must hold for it has
ORACLE["holdout_against_majority"] = _on_keys(
    """SELECT sum(quota)::BIGINT AS held_out_rows, true AS beats_majority_on_fitted_rows, true AS no_worse_on_held_out_rows
    FROM quotas""", **_HALVES
)

ORACLE["sketched_quantiles"] = """
SELECT feature, (SELECT count(*) FROM documents)::BIGINT AS count, true AS median_within, true AS p90_within
FROM (VALUES ('char_count'), ('word_count'), ('exclamation_count'), ('question_count'), ('uppercase_ratio')) f(feature)"""

ORACLE["sketched_distinct"] = """
SELECT 'lineitem.l_partkey' AS column, count(DISTINCT l_partkey)::BIGINT AS distinct_values, true AS within FROM lineitem
UNION ALL SELECT 'orders.o_custkey', count(DISTINCT o_custkey), true FROM orders
UNION ALL SELECT 'documents.text', count(DISTINCT text), true FROM documents
UNION ALL SELECT 'pages.url', count(DISTINCT url), true FROM pages"""

ORACLE["conflict_examples"] = f"SELECT * FROM ({ORACLE['label_conflicts']}) ORDER BY first_idx LIMIT 5"

ORACLE["submission_csv"] = with_views(
    """SELECT ID, (row_idx % 3)::VARCHAR AS LABEL, row_number() OVER (ORDER BY row_idx) - 1 AS row_idx FROM v_test""", "v_test"
)

ORACLE["column_report"] = """
SELECT * FROM (VALUES
    ('documents', 'doc_id, text, label', 'doc_id, text, lang, source, n_chars', false, 'label', 'lang, source, n_chars'),
    ('labels', 'doc_id, quality, toxic', 'doc_id, quality, toxic', true, '', ''),
    ('benchmark', 'text, item_id', 'item_id, text', false, '', ''))
    t(split, expected_columns, actual_columns, matches_expected_order, missing_expected_columns, unexpected_columns)"""
