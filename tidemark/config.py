"""Settings of the signal, with defaults; a YAML file can replace them."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from functools import lru_cache
from typing import Any

# The default sentiment terms.
BULLISH = ["breakout", "buy", "long buildup", "short covering", "support held", "bullish", "rally", "upside", "target hit", "accumulate", "tezi", "teji", "upar jayega", "upar jaega", "chadhega", "badhega", "kharido", "khareedo", "long banao", "buy karo", "bullish view"]
BEARISH = ["breakdown", "sell", "short buildup", "rejected at resistance", "bearish", "crash", "correction", "downside", "stop loss hit", "dump", "mandi", "giravat", "girega", "gir jayega", "neeche jayega", "neeche aayega", "tootega", "becho", "bech do", "short karo", "bearish view"]
BULLISH_DEVANAGARI = ["तेजी", "तेज़ी", "ऊपर जाएगा", "बढ़ेगा", "उछाल", "खरीदो", "खरीदें", "मजबूत", "मजबूती", "लॉन्ग"]
BEARISH_DEVANAGARI = ["मंदी", "गिरावट", "गिरेगा", "नीचे जाएगा", "टूटेगा", "बेचो", "बेचें", "कमजोर", "कमजोरी", "दबाव"]
# Words that flip a term within the next three words.
NEGATION = ["no", "not", "never", "avoid", "don't", "dont", "won't", "wont", "isn't", "isnt", "wasn't", "wasnt", "aren't", "arent", "ain't", "aint", "without"]


@dataclass(frozen=True)
class Lexicon:
    bullish: tuple[str, ...] = tuple(BULLISH)
    bearish: tuple[str, ...] = tuple(BEARISH)
    bullish_devanagari: tuple[str, ...] = tuple(BULLISH_DEVANAGARI)
    bearish_devanagari: tuple[str, ...] = tuple(BEARISH_DEVANAGARI)


@dataclass(frozen=True)
class Weights:
    sentiment: float = 0.40
    virality: float = 0.35
    momentum: float = 0.25


@dataclass(frozen=True)
class Settings:
    bucket_minutes: int = 15
    min_bucket_tweets: int = 5
    filter_market_hours: bool = True
    weights: Weights = field(default_factory=Weights)
    n_resamples: int = 500
    confidence_level: float = 0.90
    random_seed: int = 42
    lexicon: Lexicon = field(default_factory=Lexicon)
    near_duplicate_fields: tuple[str, ...] = ("text_normalized", "username", "source_hashtag")
    targets: tuple[str, ...] = ()
    max_features: int = 5000
    min_df: int = 2
    rollup_windows: tuple[str, ...] = ("1 hour", "1 day")
    rows_per_file: int = 50_000
    compression: str = "snappy"
    reservoir_size: int = 5000
    seal_grace_seconds: int = 120
    dedup_ttl_seconds: int = 172_800
    backfill_hours: int = 24


@lru_cache
def load_settings(path: str) -> Settings:
    """Settings from a flat YAML file of the names above; ``weights`` and ``lexicon`` are mappings. Unknown names raise."""
    import yaml

    with open(path, encoding="utf-8") as f:
        given: dict[str, Any] = yaml.safe_load(f) or {}
    known = {x.name for x in fields(Settings)}
    if bad := sorted(set(given) - known):
        raise ValueError(f"unknown settings: {', '.join(bad)}")
    for name, kind in (("weights", Weights), ("lexicon", Lexicon)):
        if name in given:
            given[name] = kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in given[name].items()})
    return replace(Settings(), **{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})


def distinct_tags(*groups: list[str]) -> list[str]:
    """All tags of some configured lists once each, in order."""
    return list(dict.fromkeys(t for g in groups for t in g))
