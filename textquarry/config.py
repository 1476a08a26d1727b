"""Parameters of a corpus run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class CorpusConfig:
    """Settings of every stage; an instance never changes once built.

    Defaults are the shipped settings of a full run.  ``from_mapping`` also
    takes the nested ``cleaning`` block and the longer spellings of the keys.
    """

    # cleaning
    min_length: int = 50
    max_length: int = 100_000
    remove_urls: bool = False
    remove_emails: bool = False
    control_chars: str = "intent"  # or "parity"
    # language
    allowed_languages: tuple[str, ...] | None = ("en",)
    lang_confidence: float | None = None  # None: never filters on the score
    # duplicates
    remove_duplicates: bool = True
    dup_method: str = "minhash"  # or "exact" / "hash"
    dedup_stage: str = "post_redact"  # or "pre_pii"
    num_perm: int = 128
    threshold: float = 0.8
    ngram_size: int = 5
    hash_family: str = "affine"  # or "sha1"
    # personal data
    redact_pii: bool = True
    inspect_pii: bool = True
    pii_threshold: float | None = None  # None: rule scores are not filtered
    # tokens
    tokenizer_type: str = "bpe"  # or "wordpiece"
    vocab_size: int = 30_000
    train_tokenizer: bool = True
    tokenizer_path: str | None = None
    # input and output
    sample_size: int | None = None
    shard_size: int = 10_000
    chunk_size: int | None = 10_000

    def __post_init__(self) -> None:
        allowed = {
            "control_chars": ("intent", "parity"),
            "dup_method": ("minhash", "exact", "hash"),
            "dedup_stage": ("post_redact", "pre_pii"),
            "hash_family": ("affine", "sha1"),
            "tokenizer_type": ("bpe", "wordpiece"),
        }
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {values}, not {getattr(self, name)!r}")
        if self.num_perm < 16:
            raise ValueError("num_perm must be 16 or more: fewer leave bands without a row, which all records share")
        if not 0.0 < self.threshold <= 1.0:
            raise ValueError("threshold must lie in (0, 1]")

    def with_(self, **changes) -> "CorpusConfig":
        return replace(self, **changes)

    @classmethod
    def from_mapping(cls, settings: Mapping) -> "CorpusConfig":
        """Build from a plain mapping; keys of no meaning here are ignored."""
        flat = dict(settings)
        flat.update(flat.pop("cleaning", None) or {})
        longer = {
            "minhash_num_perm": "num_perm",
            "minhash_threshold": "threshold",
            "minhash_ngram_size": "ngram_size",
        }
        # These two switches have never changed the outcome of a run from a
        # settings file, so only code that asks for them turns them on.
        for inert in ("remove_urls", "remove_emails", "lang_confidence", "pii_threshold"):
            flat.pop(inert, None)
        known = {f.name for f in fields(cls)}
        chosen = {}
        for key, value in flat.items():
            name = longer.get(key, key)
            if name in known:
                chosen[name] = value
        if "allowed_languages" in chosen:
            chosen["allowed_languages"] = tuple(chosen["allowed_languages"] or ()) or None
        return cls(**chosen)
