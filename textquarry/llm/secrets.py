"""Secrets in texts: keyword automaton, expressions near its hits, embedded checksums.

An Aho-Corasick automaton finds all keywords in one pass over a text.  Only where a keyword
was hit is an expression tried, anchored at the hit.  Keys whose format embeds a checksum
count only if it is right.  Runs of hexadecimal digits have no keyword; one expression
without alternatives finds them.

The kinds of ``BASE`` are leftmost, non-overlapping matches of their expressions: a match
that is too short to count still takes up its text.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in the order in which spans that start together are listed.
BASE = ("assign", "access", "hex")
CHECKED = ("github", "npm")
KINDS = (*BASE, *CHECKED)
SPANS = "array<struct<kind:string,start:int,end:int>>"

# The words of an assignment, letters in either case, ASCII only.
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"(?a:(?i:(password|passwd|secret|token|api_?key)))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CHECKED = re.compile(r"(gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_CHECKED_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
_LEAST_ASSIGN, _LEAST_ACCESS = 12, 18
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in (("assign", _ASSIGN_WORDS), ("access", ("akia",)), ("checked", _CHECKED_WORDS)):
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def checksum62(body: str) -> str:
    """CRC-32 of the key's body in six digits of base 62, as such keys end in."""
    n, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, k = divmod(n, 62)
        digits = _BASE62[k] + digits
    return digits


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of all secrets of a text, in code points, by start, then kind."""
    if not text:
        return []
    lowered = text.lower()
    if len(lowered) != len(text):  # some letters have longer lower-case forms
        lowered = text.translate(_ASCII_LOWER)
    spans = []
    hits = sorted((end - size + 1, kind) for end, (kind, size) in _automaton().iter(lowered))
    taken = {"assign": 0, "access": 0}
    for start, kind in hits:
        if kind == "checked":
            if (m := _CHECKED.match(text, start)) and checksum62(m[2]) == m[3]:
                spans.append(("npm" if m[1] == "npm" else "github", start, m.end()))
        elif start >= taken[kind] and (m := (_ASSIGN if kind == "assign" else _ACCESS).match(text, start)):
            taken[kind] = m.end()
            if len(m[2]) >= _LEAST_ASSIGN if kind == "assign" else m.end() - start >= _LEAST_ACCESS:
                spans.append((kind, start, m.end()))
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def redact_text(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every run of overlapping secrets replaced by the mark."""
    out, at, covered = [], 0, 0
    for _, start, end in find_spans(text):
        if start >= covered:
            out += [text[at:start], mark]
        covered = max(covered, end)
        at = covered
    return "".join([*out, text[at:]]) if out else text


def _spans(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [dict(zip(("kind", "start", "end"), s)) for s in find_spans(t)])


def _redacted(texts: pd.Series) -> pd.Series:
    return texts.map(redact_text)


def scan(docs: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """Adds the spans of all secrets of each whole text; null and empty texts have none.

    A column named as ``into`` is replaced; all others and repeated rows are kept as they are.
    """
    return docs.withColumn(into, F.pandas_udf(_spans, SPANS)(F.col(text).cast("string")))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replaces the secrets in the texts by a mark; null texts stay null."""
    return docs.withColumn(text, F.pandas_udf(_redacted, "string")(F.col(text).cast("string")))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
