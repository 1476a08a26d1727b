import re
import time

from pyspark.sql import functions as F

from textquarry.config import CorpusConfig
from textquarry.functions import patterns as P
from textquarry.functions import text as T
from textquarry.operators import cleaning

CFG = CorpusConfig(min_length=5, max_length=40)


def column(spark, values, expr):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r[0] for r in df.select("i", expr(F.col("t")).alias("o")).orderBy("i").select("o").collect()]


def test_whitespace_matches_python(spark):
    points = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    got = column(spark, [f"a{c}b" for c in points] + ["x \t\n y", " lead", "trail  "], T.collapse_whitespace)
    want = [re.sub(r"\s+", " ", f"a{c}b") for c in points] + ["x y", " lead", "trail "]
    assert got == want
    assert sum(g == "a b" for g in got[: len(points)]) == 29


def test_control_character_modes(spark):
    texts = ["a\x01b", "a[]b", "a&]b", "a^]b", "a\x02]b", "a]b"]
    assert column(spark, texts, lambda t: T.remove_control_chars(t, "intent")) == ["ab", "a[]b", "a&]b", "a^]b", "a]b", "a]b"]
    assert column(spark, texts, lambda t: T.remove_control_chars(t, "parity")) == ["a\x01b", "ab", "ab", "ab", "ab", "a]b"]


def test_gates_and_reasons(spark):
    rows = [
        (1, "abc"),
        (2, "x" * 41),
        (3, " \t\n      "),
        (4, "  hello   world  "),
        (5, None),
        (6, "abc\x01\x02\x03"),
        (7, "😀" * 5),
    ]
    df = spark.createDataFrame(rows, "seq int, text string")
    got = {r.seq: r for r in cleaning.clean(df, CFG).collect()}
    assert got[1].drop_reason == "too_short_5" and got[1].text is None
    assert got[2].drop_reason == "too_long_40"
    assert got[3].drop_reason == "empty_after_cleaning"
    assert got[4].text == "hello world" and not got[4].dropped and got[4].drop_reason is None
    assert got[5].drop_reason == "null_text"
    assert got[6].drop_reason == "empty_after_cleaning"
    assert got[7].text == "😀" * 5
    totals = cleaning.cleaning_totals(cleaning.clean(df, CFG)).first()
    assert (totals.total_processed, totals.total_dropped) == (7, 5)
    assert cleaning.clean_batch(df, CFG).columns == ["text", "dropped", "drop_reason"]


def test_url_email_and_whitespace_removal(spark):
    assert column(spark, ["see http://a.b/c?d=e#f now", "https://x.y/~z", "none"], T.remove_urls) == ["see #f now", "~z", "none"]
    assert column(spark, ["a b.c@d.org e", "x@y.c|m", "no at"], T.remove_emails) == ["a  e", "", "no at"]
    assert column(spark, ["a  b\n\n\n\nc \n d "], T.normalize_whitespace) == ["a b\n\nc \n d"]


def test_optional_removal_is_off_by_default(spark):
    df = spark.createDataFrame([(1, "write to me@example.com please")], "seq int, text string")
    assert "@" in cleaning.clean(df, CFG).first().text
    assert "@" not in cleaning.clean(df, CFG.with_(remove_emails=True)).first().text


def test_ngrams_by_code_point(spark):
    texts = ["a😀b😀c", "ab", "hello", "new\nline"]
    got = column(spark, texts, lambda t: T.char_ngrams(t, 3))
    assert got == [[t[i : i + 3] for i in range(len(t) - 2)] for t in texts]


def test_settings_from_mapping():
    cfg = CorpusConfig.from_mapping(
        {"cleaning": {"min_length": 7, "remove_urls": True}, "minhash_num_perm": 64, "allowed_languages": ["en"], "workers": 8}
    )
    assert cfg.min_length == 7 and cfg.num_perm == 64 and cfg.allowed_languages == ("en",) and not cfg.remove_urls


def test_whitespace_is_collapsed_by_plain_patterns(spark):
    odd = [chr(c) for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]]
    near = [chr(c) for c in (8, 14, 27, 0x84, 0x9F, 0x180E, 0x167F, 0x1681, 0x200B, 0x2027, 0x2060, 0x3001, 0xFEFF)]
    texts = [f"a{x}b{x}{y}{x}c {y}{x}d{x} e{x}" for x in odd for y in (odd[0], " ", " ")] + [f"a{x}b {x}c" for x in near]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", T.collapse_whitespace(F.col("text")).alias("got")).collect()
    assert len(odd) == 29
    assert all(r.got == re.sub(r"\s+", " ", r.text) for r in rows)
    # A pattern that tries two ways at every character costs several times as much.
    words = spark.range(400).select(F.repeat(F.lit("some words of a line\n" * 20), 100).alias("text")).cache()
    words.count()

    def seconds(column):
        times = []
        for _ in range(4):
            before = time.perf_counter()
            words.agg(F.sum(F.length(column))).collect()
            times.append(time.perf_counter() - before)
        return min(times)

    either = rf"[\t-\r\x1c-\x1f\x85\xa0  -     　]{P.WHITESPACE}*| {P.WHITESPACE}+"
    assert seconds(T.collapse_whitespace(F.col("text"))) < 0.7 * seconds(F.regexp_replace("text", either, " "))
