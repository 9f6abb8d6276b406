"""Settings of the cleaning and sharding steps."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass, replace


@dataclass(frozen=True)
class Dedup:
    mode: str = "lsh"
    fuzzy_threshold: float = 0.8
    num_perm: int = 128


@dataclass(frozen=True)
class Quality:
    min_content_length: int = 500
    max_content_length: int = 100_000
    min_quality_score: float = 0.6


@dataclass(frozen=True)
class Language:
    # fixed values: the supported languages
    supported_languages: tuple = ("en", "zh", "es", "fr", "de", "ja", "ko", "ru")
    min_confidence: float = 0.7


@dataclass(frozen=True)
class Shards:
    max_length: int = 2048
    min_tokens: int = 10
    val_split: float = 0.05
    shard_size_mb: int = 512
    bytes_per_doc: int = 2048
    seed: int = 0


@dataclass(frozen=True)
class Config:
    deduplication: Dedup = field(default_factory=Dedup)
    quality: Quality = field(default_factory=Quality)
    language: Language = field(default_factory=Language)
    shards: Shards = field(default_factory=Shards)


def merge(base, overrides: dict):
    """Deep merge: a partial section keeps the defaults of its other settings."""
    known = {f.name: getattr(base, f.name) for f in fields(base)}
    unknown = set(overrides) - set(known)
    if unknown:
        raise KeyError(f"unknown settings: {sorted(unknown)}")
    new = {
        name: merge(known[name], value) if is_dataclass(known[name])
        else tuple(value) if isinstance(known[name], tuple) else value
        for name, value in overrides.items()
    }
    return replace(base, **new)
