"""Scalar column helpers (X1-X8): ids, tiers, event timestamps, padding, formatting."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: cohort-sheet tier spellings -> the four canonical tiers
TIER_ALIASES = {
    "verygood": "verygood", "very_good": "verygood", "very good": "verygood", "vg": "verygood",
    "excellent": "verygood", "बहुत अच्छी": "verygood", "बहुत अच्छा": "verygood",
    "good": "good", "g": "good", "अच्छी": "good", "अच्छा": "good",
    "basic": "basic", "average": "basic", "ok": "basic", "बेसिक": "basic",
    "none": "none", "no_bonus": "none", "nobonus": "none", "poor": "none", "bad": "none",
    "खराब": "none", "support": "none",
}

# fixed values: default bonus / support amount per canonical tier
TIER_AMOUNTS = {"verygood": 2000, "good": 1500, "basic": 1000, "none": 2000}


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def tier_alias(tier: Column) -> Column:
    """trim + lower, then the alias table; unknown spelling -> NULL."""
    return F.element_at(_map(TIER_ALIASES), F.lower(F.trim(tier)))


def tier_amount(tier: Column) -> Column:
    return F.element_at(_map(TIER_AMOUNTS), tier)


def sanitize_id(x: Column) -> Column:
    """lower-case and strip everything but [a-z0-9]."""
    return F.regexp_replace(F.lower(x), "[^a-z0-9]", "")


def event_ts_int(x: Column) -> Column:
    """YYYYMMDDHHMMSS integer -> timestamp_ntz."""
    return F.to_timestamp_ntz(x.cast("string"), F.lit("yyyyMMddHHmmss"))


def zero_pad(x: Column, width: int = 6) -> Column:
    """Left-pad with zeros to ``width`` but never truncate (lpad alone would cut longer ids)."""
    s = x.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def grouped(n: Column) -> Column:
    """Western comma grouping of an integer ("2,100")."""
    return F.format_number(n, 0)
