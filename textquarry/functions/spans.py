"""Personal-data spans as column expressions, offsets in code points."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

ENTITIES = "array<struct<type:string,start:int,end:int,score:double,text:string>>"


@dataclass(frozen=True)
class Rule:
    """One recogniser: entity type, Java pattern and score.

    ``needs`` is a literal that every match contains; texts without it skip
    the pattern.
    """

    type: str
    pattern: str
    score: float
    needs: str | None = None


DEFAULT_RULES = (
    Rule("EMAIL", P.EMAIL, P.EMAIL_SCORE, needs="@"),
    Rule("PHONE", P.PHONE, P.PHONE_SCORE),
    Rule("SSN", P.SSN, P.SSN_SCORE),
)


def matches(text: Column, rule: Rule) -> Column:
    """Every match of one rule, in text order."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    if rule.needs is None:
        return found
    return F.when(F.contains(text, F.lit(rule.needs)), found).otherwise(F.array().cast("array<string>"))


def rule_spans(text: Column, rule: Rule) -> Column:
    """Spans of one rule.

    Splitting at the pattern gives the pieces between the matches, so a match
    starts where the pieces and matches before it end.
    """
    none = F.array().cast(ENTITIES)
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    pieces = F.split(text, rule.pattern, -1)
    steps = F.zip_with(
        F.slice(pieces, 1, F.size(hits)),
        hits,
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")),
    )

    def step(done: Column, nxt: Column) -> Column:
        start = done["at"] + nxt["gap"]
        end = start + F.length(nxt["hit"])
        span = F.struct(
            F.lit(rule.type).alias("type"),
            start.alias("start"),
            end.alias("end"),
            F.lit(float(rule.score)).alias("score"),
            nxt["hit"].alias("text"),
        )
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    folded = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        step,
        lambda done: done["spans"],
    )
    present = F.regexp_like(text, F.lit(rule.pattern))
    if rule.needs is not None:
        present = F.contains(text, F.lit(rule.needs)) & present
    return F.when(present, folded).otherwise(none)


def entities(
    text: Column, rules: Sequence[Rule] = DEFAULT_RULES, min_score: float | None = None
) -> Column:
    """All spans, rule after rule; overlapping spans are all reported."""
    active = [r for r in rules if min_score is None or r.score >= min_score]
    if not active:
        return F.array().cast(ENTITIES)
    return F.concat(*[rule_spans(text, rule) for rule in active])


def redact(text: Column, spans: Column) -> Column:
    """Replace each span by ``<TYPE>``.

    Spans are taken by start, at equal starts in the order given; one that
    begins inside a span already replaced is left out.
    """
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s, i: F.struct(s["start"].alias("start"), i.alias("nth"), s["end"].alias("end"), s["type"].alias("type")),
        )
    )

    def step(done: Column, s: Column) -> Column:
        piece = F.concat(
            done["out"],
            F.substring(text, done["at"] + 1, s["start"] - done["at"]),
            F.lit("<"),
            s["type"],
            F.lit(">"),
        )
        fits = s["start"] >= done["at"]
        return F.struct(
            F.when(fits, piece).otherwise(done["out"]).alias("out"),
            F.when(fits, s["end"]).otherwise(done["at"]).alias("at"),
        )

    rebuilt = F.aggregate(
        ordered,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        step,
        lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, rebuilt).otherwise(text)
