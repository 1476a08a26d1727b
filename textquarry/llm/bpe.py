"""Token ids of whole texts by a byte-level tokenizer file.

Where a vocabulary's ids rank its merges, as those of byte-level vocabularies do, two libraries
give the same ids.  Texts go through the faster one, except for parts whose letters the two may
class differently, added tokens, and runs without a space that its merges are quadratic in.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LONG_TEXT, LONG_RUN = 20_000, 2_000
_CUT = re.compile(r"(?<=\S)(?= )")
_LONG_SPACE = re.compile(r"\s{%d}" % LONG_RUN)
# Fixed value: the pattern of byte-level pre-tokenizers.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def letter_bytes() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes as: printable ones as themselves, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def ranked_encoder(path: str):
    """An encoder by ranks for a tokenizer file whose ids rank its merges; None for others."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        settings = json.load(f)
    kind, model = settings["pre_tokenizer"] or {}, settings["model"]
    if settings["normalizer"] or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex", True):
        return None
    vocab, merges = model["vocab"], model["merges"]
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
    added = {t["content"] for t in settings["added_tokens"]}
    letters = letter_bytes()
    ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in added}
    if made != sorted(made) or len(ranks) != 256 + len(made):
        return None
    return tiktoken.Encoding("ranked", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class PieceEncoder:
    """Encodes texts to unsigned 32-bit ids in the machine's byte order, as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._ranked = ranked_encoder(path)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]

    def _plain(self, text: str) -> bool:
        """No added token, and no letters whose class may depend on a library's version of Unicode."""
        if any(a in text for a in self._added):
            return False
        try:
            return text.isascii() or bool(text.encode("latin-1"))
        except UnicodeEncodeError:
            return False

    def _runs_long(self, text: str) -> bool:
        return len(text) > LONG_TEXT and (max(map(len, text.split()), default=0) > LONG_RUN or bool(_LONG_SPACE.search(text)))

    def _exact(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self._ranked is None:
            return self._exact(text)
        if self._plain(text) and not self._runs_long(text):
            return array("I", self._ranked(text)).tobytes()
        # The pre-tokenizer never reaches over a space that follows a non-space.
        parts = _CUT.split(text)
        return b"".join(
            array("I", self._ranked(p)).tobytes() if len(p) <= LONG_RUN and self._plain(p) else self._exact(p) for p in parts
        )


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder for each tokenizer file and worker process."""
    return PieceEncoder(path)
