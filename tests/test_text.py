import html
import html.entities
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from lexisieve.functions import normalize as N
from lexisieve.functions.measures import report_measures, surface_features
from lexisieve.functions.tokens import char_ngrams, with_term_counts, word_ngrams, word_tokens


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, TEXT string")


def values(df, col):
    return [row[0] for row in df.orderBy("i").select(col).collect()]


def run(spark, texts, steps):
    return values(N.with_steps(frame(spark, texts), "TEXT", "out", steps), "out")


def test_duplicate_key(spark):
    df = N.with_duplicate_key(frame(spark, ["  Straße\tA  ", None, "\n\x1c A  b"]))
    assert values(df, "duplicate_key") == ["strasse a", "", "a b"]


def test_duplicate_key_is_full_casefold(spark):
    chars = [chr(p) for p in range(0x20000) if not 0xD800 <= p <= 0xDFFF]
    df = frame(spark, [f"x{c}y" for c in chars])
    got = values(N.with_duplicate_key(df), "duplicate_key")
    space = re.compile(r"\s+")
    wrong = [
        c for c, key in zip(chars, got)
        if key != space.sub(" ", f"x{c}y").casefold()
    ]
    # only letters this Python's Unicode tables do not know yet
    assert [c for c in wrong if unicodedata.category(c) != "Cn"] == []


def test_case_fold_fast_path_ranges():
    inside = re.compile(f"[{re.sub(r'\\x\{([0-9a-f]+)\}', lambda m: chr(int(m[1], 16)), N._FOLDED)}]")
    for point in range(0x20000):
        char = chr(point)
        if inside.match(char) and char.lower() == char and char != "ß":
            assert char.casefold() == char


def test_nfkc_fast_path_ranges():
    inside = re.compile(
        f"[{re.sub(r'\\x\{([0-9a-f]+)\}', lambda m: chr(int(m[1], 16)), N._NFKC_STABLE)}]"
    )
    joins_back = {
        unicodedata.decomposition(chr(p)).split()[1]
        for p in range(0x110000)
        if len(unicodedata.decomposition(chr(p)).split()) == 2
        and not unicodedata.decomposition(chr(p)).startswith("<")
    }
    for point in range(0x20000):
        char = chr(point)
        if inside.match(char):
            assert unicodedata.normalize("NFKC", char) == char
            assert unicodedata.combining(char) == 0
            assert f"{point:04X}" not in joins_back


def test_base_text(spark):
    cases = {
        "&lt;b&gt;Hi&lt;/b&gt; a<br/>b&nbsp;c\N{HORIZONTAL ELLIPSIS}": "Hi a b c...",
        "&amp;lt;i&amp;gt;": "&lt;i&gt;",
        "x\N{EM DASH}y": "x - y",
        "don`t": "don't",
        "a\N{ZERO WIDTH SPACE}b": "a b",
        "a\x07b\N{NON-BREAKING HYPHEN}c": "a b - c",
        "\N{LATIN SMALL LIGATURE FI}n e\N{COMBINING ACUTE ACCENT}": "fin \N{LATIN SMALL LETTER E WITH ACUTE}",
        "a < BR / >b<<br>c>d &copy &notanentity; &#65;&#x42": "a b d \N{COPYRIGHT SIGN} ¬anentity; AB",
        "\N{LEFT SINGLE QUOTATION MARK}q\N{RIGHT SINGLE QUOTATION MARK} "
        "\N{LEFT DOUBLE QUOTATION MARK}r\N{RIGHT DOUBLE QUOTATION MARK}": "'q' \"r\"",
        None: "",
    }
    assert values(N.with_base_text(frame(spark, list(cases))), "base_text") == list(cases.values())


CLEAN = {
    "I don't like it!!! 2/10": "I do not like it __repeat_exclamation__ __rating_low__",
    "Sooooo good, 8 out of 10 ?!?!": "Soo good, __rating_high__ __mixed_punct__",
    "Mail Bob@Ex.com or www.x.io/a?b now": "Mail __email__ or __url__ now",
    "4.5 stars... B+ overall; daren't go": "__rating_high__ ... __grade_high__ overall; dare not go",
    "three-star film, F- acting??": "__rating_mid__ film, __grade_low__ acting __repeat_question__",
    "I CAN'T. AIN'T": "I can not. is not",
    "8/10/2020 and 100/10": "8/10/2020 and 100/10",
    "!!? huh": "! __mixed_punct__ huh",
    "4.2/10": "__rating_mid__",
    "4.8/10": "__rating_mid__",
    "10.5/10": "10. __rating_mid__",
    "9.9.9/10": "9. __rating_high__",
    "8/10/10": "8/ __rating_high__",
    "3.5 stars": "__rating_high__",
    "2-star": "__rating_low__",
    "2.1 star": "__rating_mid__",
    "b- aa+ a-list": "b- aa+ a-list",
    "f-a+": "f- __grade_high__",
    "you're they'LL e\N{COMBINING ACUTE ACCENT}can't": "you are they will \N{LATIN SMALL LETTER E WITH ACUTE}can't",
    "FIVE stars zerostar": "__rating_high__ __rating_low__",
}


def test_clean_text(spark):
    df = N.with_clean_text(N.with_base_text(frame(spark, list(CLEAN))))
    assert values(df, "clean_text") == list(CLEAN.values())


def test_negation_goldens(spark):
    texts = ["not a good idea, at all really fine. ok", "never say no to it"]
    assert run(spark, texts, N.NEGATION_STEPS) == [
        "not a_NEG good_NEG idea_NEG , at_NEG all really fine . ok",
        "never say_NEG no to_NEG it_NEG",
    ]


def sequential_scope(tokens):
    """Brute-force statement of the rule, token by token."""
    marked, left = [], 0
    for token in tokens:
        if token in set(N.NEGATION_BOUNDARIES):
            left = 0
        elif token[0].isalnum() or token[0] == "_":
            opens = token.lower() in N.NEGATION_TRIGGERS
            if left and not opens:
                token, left = token + "_NEG", left - 1
            elif opens:
                left = N.NEGATION_WINDOW
        marked.append(token)
    return " ".join(marked)


def test_negation_against_brute_force(spark):
    rng = random.Random(7)
    pool = ["not", "No", "nor", "a", "b1", "été", ",", "-", ".", ";", "(", "nothing"]
    lists = [[rng.choice(pool) for _ in range(rng.randint(1, 40))] for _ in range(3000)]
    lists.append(["not"] + [","] * 20000 + ["a", "b1"])
    got = run(spark, [" ".join(tokens) for tokens in lists], N.NEGATION_STEPS)
    assert got == [sequential_scope(tokens) for tokens in lists]


def test_surface_features(spark):
    df = N.with_base_text(frame(spark, ["Wow!! 10 OK?", None]))
    rows = df.orderBy("i").select(*[c.alias(n) for n, c in surface_features(F.col("base_text")).items()])
    first, second = rows.collect()
    assert list(first) == pytest.approx(
        [2.564949, 1.386294, 3, 2, 1, 0.6, 0.166667, 0.25, 1], abs=1e-6
    )
    assert list(second) == [0.0] * 9


def test_report_measures(spark):
    texts = ["Hi!!! a <b>X</b> www.q.io?", None, " \t", "don't 'a' b''c a'' x"]
    rows = frame(spark, texts).select("i", *[c.alias(n) for n, c in report_measures(F.col("TEXT")).items()])
    first, second, third, fourth = rows.orderBy("i").collect()
    assert list(first)[1:] == [26.0, 3.0, 3.0, 1.0, 2 / 12, False, True, True, True]
    assert list(second)[1:] == [0.0, 0.0, 0.0, 0.0, 0.0, True, False, False, False]
    assert third.is_blank_text and third.char_count == 2
    expected = len(re.findall(r"\b\w[\w']+\b", texts[3]))
    assert fourth.word_count == expected


def test_char_ngrams(spark):
    [grams] = values(frame(spark, ["ab  cde"]).withColumn("g", char_ngrams(F.col("TEXT"), 3, 5)), "g")
    assert sorted(grams) == sorted(
        [" ab", "ab ", " ab ", " cd", "cde", "de ", " cde", "cde ", " cde "]
    )


def grams_by_hand(text, low, high):
    found = []
    for word in text.lower().split():
        padded = f" {word} "
        for size in range(low, high + 1):
            found += [padded[i : i + size] for i in range(len(padded) - size + 1)]
    return sorted(found)


def test_char_ngrams_against_brute_force(spark):
    rng = random.Random(11)
    pool = ["a", "B", "é", " ", "\t", "\N{GRINNING FACE}", "_", "1", "\N{IDEOGRAPHIC SPACE}"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    df = frame(spark, texts).withColumn("g", char_ngrams(F.col("TEXT"), 3, 6))
    assert [sorted(g) for g in values(df, "g")] == [grams_by_hand(t, 3, 6) for t in texts]


def test_word_ngrams_and_counts(spark):
    df = frame(spark, ["Aa bb, aa x bb", "", "one"]).withColumn("w", word_tokens(F.col("TEXT")))
    df = df.withColumn("g", word_ngrams(F.col("w"), 1, 3))
    grams = values(df, "g")
    assert sorted(grams[0]) == sorted(
        ["aa", "bb", "aa", "bb", "aa bb", "bb aa", "aa bb", "aa bb aa", "bb aa bb"]
    )
    assert grams[1:] == [[], ["one"]]
    counts = values(with_term_counts(df, F.col("g")), "term_counts")
    assert {(r.term, r.tf) for r in counts[0]} == {
        ("aa", 2), ("bb", 2), ("aa bb", 2), ("bb aa", 1), ("aa bb aa", 1), ("bb aa bb", 1)
    }
    assert counts[1] == [] and [(r.term, r.tf) for r in counts[2]] == [("one", 1)]


def test_whitespace_collapse_is_idempotent(spark):
    once = run(spark, [" a \t\n b ", "x", ""], [N.collapse_space])
    assert run(spark, once, [N.collapse_space]) == once


def test_entities_equal_html5_without_python(spark):
    """Every name with and without its semicolon, numbers of all kinds, and what is no reference."""
    texts = []
    for name in html.entities.html5:
        bare = name.rstrip(";")
        texts += [f"x &{bare}; y &{bare} z", f"&{bare}xyz;", f"&{bare}=1"]
    points = [*range(400), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFE, 0x10000, 0x1FFFE, 0x10FFFF]
    for point in [*points, 0x110000, 10**9, 10**12, 2**64 + 65]:
        texts += [f"&#{point};", f"&#{point}", f"&#x{point:x};", f"&#X{point:X}g", f"&#{point:030};"]
    texts += ["&", "&&amp;", "&amp;amp;", "&#;", "&#x;", "& amp;", "a&b<c&notit;", "&" + "a" * 40 + ";", "&amp" * 30, ""]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "x string")
    read = df.select("x", N.unescape_html(F.col("x")).alias("y"))
    assert "Python" not in read._jdf.queryExecution().toString()
    for row in read.collect():
        assert row.y == (None if row.x is None else html.unescape(row.x)), row.x


def test_frequent_characters_are_turned_away_before_the_long_class(spark):
    """The short ranges in front of a class change no character's verdict."""
    chars = spark.range(0, 0x11000).filter("id < 55296 or id > 57343").select(
        F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c")
    )
    for ranges in (N._FOLDED, N._NFKC_STABLE):
        quick = N._other_than(ranges)
        assert quick.index("(?!") < quick.index(ranges)
        assert chars.filter(F.col("c").rlike(quick) != F.col("c").rlike(f"[^{ranges}]")).count() == 0
