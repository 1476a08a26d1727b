import random
import re

import pytest
from pyspark.sql import functions as F

from textquarry.config import CorpusConfig
from textquarry.functions.spans import DEFAULT_RULES, ENTITIES, Rule, entities, redact
from textquarry.operators import pii

PYTHON = [(r.type, r.pattern.removeprefix("(?U)"), r.score) for r in DEFAULT_RULES]


def texts():
    rng = random.Random(3)
    bits = ["a.b@c.org", "555-123-4567", "123-45-6789", "5551234567", "😀", "é", " ", "x", "-", "@", "12", ".", "you@home.c|o"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(400)] + [""]


def test_spans_equal_finditer(spark):
    given = texts()
    df = spark.createDataFrame(list(enumerate(given)), "i int, text string")
    got = {r.i: r.pii_entities for r in pii.detect(df).collect()}
    for i, t in enumerate(given):
        want = [(k, m.start(), m.end(), s, m.group()) for k, p, s in PYTHON for m in re.finditer(p, t)]
        assert [tuple(e) for e in got[i]] == want, t


def test_redaction_takes_leftmost_and_rebuilds(spark):
    given = texts()
    df = spark.createDataFrame(list(enumerate(given)), "i int, text string")
    got = {r.i: r.text for r in pii.anonymize(df).collect()}
    for i, t in enumerate(given):
        spans = [(m.start(), n, m.end(), k) for n, (k, p, _) in enumerate(PYTHON) for m in re.finditer(p, t)]
        out, at = "", 0
        for start, _, end, kind in sorted(spans):
            if start >= at:
                out += t[at:start] + f"<{kind}>"
                at = end
        assert got[i] == out + t[at:]


@pytest.mark.parametrize(
    "text,want",
    [("555-123-4567@x.com", "<EMAIL>"), ("call 555.123.4567 or a@b.io", "call <PHONE> or <EMAIL>"), ("123-45-6789", "<SSN>"), ("plain", "plain")],
)
def test_redaction_examples(spark, text, want):
    df = spark.createDataFrame([(text,)], "text string")
    assert pii.anonymize(df).first().text == want


def test_given_spans_and_rules(spark):
    df = spark.sql(f"SELECT 'Ann met Bob' AS text, CAST(array(struct('PERSON', 0, 3, 0.9D, 'Ann'), struct('PERSON', 8, 11, 0.4D, 'Bob')) AS {ENTITIES}) AS e")
    assert df.select(redact(F.col("text"), F.col("e"))).first()[0] == "<PERSON> met <PERSON>"
    rules = [Rule("WORD", r"(?U)\bB\w+", 0.4), Rule("NAME", r"(?U)\bA\w+", 0.9)]
    found = df.select(entities(F.col("text"), rules, 0.5).alias("e")).first().e
    assert [(e.type, e.start) for e in found] == [("NAME", 0)]


def test_annotation(spark):
    df = spark.createDataFrame([(1, "mail a@b.org now", False), (2, "nothing", False), (3, None, True)], "seq int, text string, dropped boolean")
    rows = {r.seq: r for r in pii.annotate(df, CorpusConfig()).collect()}
    assert rows[1].text == "mail <EMAIL> now" and rows[1].length == 16 and rows[1].pii_redacted and rows[1].pii_entities[0].start == 5
    assert rows[2].has_pii is False and rows[2].pii_count == 0 and rows[2].length == 7
    assert rows[3].has_pii is None and rows[3].length is None
    seen = pii.annotate(df, CorpusConfig(redact_pii=False)).filter("seq = 1").first()
    assert "@" in seen.text and seen.has_pii and not seen.pii_redacted
    off = pii.annotate(df, CorpusConfig(redact_pii=False, inspect_pii=False)).filter("seq = 1").first()
    assert not off.has_pii and off.pii_count == 0
