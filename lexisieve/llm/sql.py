"""SQL for the queries of this package that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _escaped(column: str) -> str:
    done = f"replace({column}, '\\', '\\\\')"
    for control in (
        "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[/TURN]",
    ):
        done = f"replace({done}, '{control}', '{control[0]}\\{control[1:]}')"
    return done


ORACLE["op3_chat_format"] = f"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
    SELECT *, row_number() OVER w - 1 AS pos,
        coalesce(lag(role) OVER w, 'start') AS before, row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS last
    FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
    SELECT *,
        (before IN ('start', 'assistant') AND role = 'user') OR (before = 'start' AND role = 'system')
        OR (before = 'system' AND role = 'user') OR (before = 'user' AND role = 'assistant') AS legal,
        length({_escaped('text')}) + CASE role WHEN 'system' THEN 19 WHEN 'user' THEN 15
            WHEN 'assistant' THEN 7 ELSE 20 + length({_escaped('role')}) END AS chars
    FROM placed
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars,
    bool_and(legal) AND bool_or(last AND role = 'assistant') AS valid,
    (min(pos) FILTER (NOT legal))::BIGINT AS first_bad
FROM judged GROUP BY conv_id"""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op1_jaccard_join"] = f"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0)
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY 1, 2
), link AS (
    SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
    WHERE 100 * inter >= 80 * (x.n + y.n - inter)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
)
SELECT a AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id
FROM reach LEFT JOIN size ON size.doc_id = a GROUP BY 1"""


def _license_sql() -> str:
    from lexisieve.llm.licenses import PHRASES, TEMPLATES

    rows = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
    places = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, i - 1 AS pos FROM placed WHERE array_to_string(w[i:i + {len(p.split()) - 1}], ' ') = '{p}'"
        for p, label in PHRASES.items()
    )
    return f"""
WITH split AS (
    SELECT doc_id, list_filter(string_split_regex({LOWERED}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
    FROM documents
), notice(number, label, text) AS (VALUES {rows}),
template AS (
    SELECT number, label, list_distinct(string_split(text, ' ')) AS words,
        CASE WHEN len(list_distinct(string_split(text, ' '))) < 10 THEN len(list_distinct(string_split(text, ' ')))
            ELSE ceil(0.8 * len(list_distinct(string_split(text, ' '))) - 1e-9) END AS need,
        2 * greatest(32, 2 ** ceil(log2(len(string_split(text, ' ')))))::BIGINT AS size
    FROM notice
), placed AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM split),
base AS ({places}),
block AS (
    SELECT DISTINCT doc_id, number, label, words, need, list_distinct(list_intersect(w[i:i + size - 1], words)) AS b
    FROM split JOIN template ON len(list_distinct(list_intersect(w, words))) >= need, unnest(range(1, len(w) + 1)) AS every(i)
), met AS (
    SELECT doc_id, label, len(b) / len(words) AS c FROM block WHERE len(b) >= need
), every_label AS (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM met)
SELECT doc_id, len(w)::BIGINT AS n_words,
    (SELECT count(*) FROM base b WHERE b.doc_id = s.doc_id)::BIGINT AS n_base,
    (SELECT min(pos) FROM base b WHERE b.doc_id = s.doc_id)::BIGINT AS first_word,
    (SELECT max(pos) FROM base b WHERE b.doc_id = s.doc_id)::BIGINT AS last_word,
    coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM base b WHERE b.doc_id = s.doc_id), '') AS base_labels,
    coalesce((SELECT string_agg(label, ',' ORDER BY label) FROM every_label e WHERE e.doc_id = s.doc_id), '') AS labels,
    coalesce((SELECT max(c) FROM met m WHERE m.doc_id = s.doc_id), 0)::DOUBLE AS score
FROM split s"""


ORACLE["op9_license_scan"] = _license_sql()


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string, unsigned, by the 256 entries ``t`` of ``crc_table``."""
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c)::UBIGINT)"
    return (
        f"xor(list_reduce(list_concat([4294967295::UBIGINT], {codes}),"
        " lambda a, b: xor(a >> 8, t[(xor(a, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)"
    )


CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n::UBIGINT], range(8)::UBIGINT[]),
        lambda c, i: xor(c >> 1, 3988292384::UBIGINT * (c & 1)))) AS t
)"""

ORACLE["op13_prefix_trie"] = f"""
WITH {CRC_TABLE}, given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM given
), conv AS (
    SELECT conv_id, ({_crc32("conv_id::VARCHAR")} % 4)::BIGINT AS h FROM (SELECT DISTINCT conv_id FROM given), crc_table
), rebuilt AS (
    SELECT c.conv_id, p.pos, p.role, p.text FROM conv c JOIN placed p ON p.conv_id = c.conv_id - c.conv_id % 20 AND p.pos <= c.h
    UNION ALL SELECT c.conv_id, 1000000 + p.pos, p.role, p.text FROM conv c JOIN placed p ON p.conv_id = c.conv_id AND p.pos > c.h
), turn AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth,
        sha256(length(role) || ':' || role || text) AS id,
        len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
    FROM rebuilt
), starts AS (
    SELECT conv_id, depth, words, string_agg(id, '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM turn
    UNION ALL SELECT conv_id, 0, 0, '' FROM conv
), node AS (
    SELECT key, any_value(depth) AS depth, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs
    FROM starts GROUP BY key
), counted AS (
    SELECT a.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM node b WHERE b.depth = a.depth + 1 AND left(b.key, 64 * a.depth) = a.key) AS n_children
    FROM node a LEFT JOIN node p ON p.depth = a.depth - 1 AND p.key = left(a.key, 64 * p.depth)
), above AS (
    SELECT left(key, 64 * d) AS key, n_children = 0 AS leaf, (n_convs - 1) * words AS saved
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted)
), whole AS (
    SELECT key, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved FROM above GROUP BY key
), ends AS (
    SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM (SELECT conv_id, max_by(key, depth) AS key FROM starts GROUP BY conv_id) GROUP BY key
)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
    n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM counted JOIN whole USING (key) LEFT JOIN ends USING (key)"""


ORACLE["op12_norm_sorted_top_k"] = """
WITH v AS (
    SELECT vec_id, any_value(list_transform(embedding, lambda x: floor(256 * x::DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id
), ranked AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS rank
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5"""


def _quality_sql() -> str:
    from lexisieve.llm.quality import COMMON_WORDS

    space = r"[\x20\x09-\x0D]"
    classes = ["[a-z]", space, "[A-Z]", "[0-9]", r"\p{L}", "[#*$%&|<>]"]
    left = ["t"]
    for pattern in classes:
        left.append(f"regexp_replace({left[-1]}, '{pattern}', '', 'g')")
    chars = ", ".join(
        [f"length({a}) - length({b})" for a, b in zip(left, left[1:])] + [f"length({left[-1]})"]
    )
    forms = "list_transform({0}, lambda c: len(list_filter(w, lambda v: v IN (c, upper(c[1]) || c[2:], upper(c)))))"
    common = " ".join(
        f"WHEN '{lang}' THEN list_concat({forms.format(words)}, [len(w) - list_sum({forms.format(words)})])"
        for lang, words in COMMON_WORDS.items()
    )

    def distance(a: str, b: str) -> str:
        p, q = f"({a}[i] / list_sum({a}))", f"({b}[i] / list_sum({b}))"
        part = "CASE WHEN {0} > 0 THEN {0} * log2({0} * 2 / ({0} + {1})) ELSE 0 END"
        each = f"list_transform(range(1, len({a}) + 1), lambda i: {part.format(p, q)} + {part.format(q, p)})"
        return f"CASE WHEN list_sum({a}) > 0 AND list_sum({b}) > 0 THEN sqrt(greatest(list_sum({each}) / 2, 0)) END"

    return f"""
WITH base AS (
    SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), counted AS (
    SELECT *, [{chars}]::DOUBLE[] AS chars, (CASE lang {common} END)::DOUBLE[] AS common,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM base
), again AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ')) AS n
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM base WHERE len(w) >= 8)) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM again, unnest(range(8)) AS step(j) GROUP BY doc_id
), told AS (
    SELECT doc_id, lang, len(w)::BIGINT AS n_words, (length(t) - chars[2])::BIGINT AS word_chars,
        (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
        len(w) < 20 OR 100 * coalesce(n, 0) > 30 * len(w) AS base_failed, chars, common
    FROM counted LEFT JOIN covered USING (doc_id)
), sums AS (
    SELECT lang, i, sum(chars[i]) AS c, sum(common[i]) AS w FROM told, unnest(range(1, 16)) AS place(i) WHERE NOT base_failed GROUP BY lang, i
), reference AS (
    SELECT lang AS ref_lang, list(c ORDER BY i) FILTER (c IS NOT NULL) AS ref_chars, list(w ORDER BY i) FILTER (w IS NOT NULL) AS ref_common
    FROM sums GROUP BY lang
), judged AS (
    SELECT *, list_sum(chars) >= 200 AND list_sum(ref_chars) >= 10000 AS long_enough,
        {distance('chars', 'ref_chars')} AS cd, {distance('common', 'ref_common')} AS wd
    FROM told LEFT JOIN reference ON lang IS NOT DISTINCT FROM ref_lang
), guarded AS (
    SELECT *, CASE WHEN long_enough THEN cd END AS char_d, CASE WHEN long_enough AND n_words >= 100 THEN wd END AS word_d FROM judged
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT (coalesce(char_d, 0) > 0.25 OR coalesce(word_d, 0) > 0.3) AS kept,
    round(char_d, 6) AS char_distance, round(word_d, 6) AS word_distance
FROM guarded"""


ORACLE["op7_quality_rules"] = _quality_sql()
