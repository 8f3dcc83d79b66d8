"""Profile token sink: per identity, every banner token as a string (wide -> long)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

C = F.col


def profile_tokens(df: DataFrame, identity: str, tokens: Sequence[str], prefix: str = "banner_") -> DataFrame:
    """K5: (identity, token, value-as-string) rows via unpivot; NULL values become ''."""
    wide = df.select(identity, *[F.coalesce(C(t).cast("string"), F.lit("")).alias(f"{prefix}{t}") for t in tokens])
    return wide.unpivot([identity], [f"{prefix}{t}" for t in tokens], "token", "value")


def push_tokens(tokens: DataFrame, send: Callable[[list], None], batch: int = 1000) -> None:
    """Batch sink hook: ``send`` receives lists of up to ``batch`` rows, called inside each task."""

    def part(rows):
        buf = []
        for r in rows:
            buf.append(r.asDict())
            if len(buf) >= batch:
                send(buf)
                buf = []
        if buf:
            send(buf)

    tokens.foreachPartition(part)


def clear_flags(flags: DataFrame, identity: str = "profile_id", flag: str = "flag") -> DataFrame:
    """K6: end-of-day reset — every identity whose flag is set gets the flag written back as 'false'."""
    return (flags.where(F.lower(C("value")) == "true")
            .select(identity, C(flag), F.lit("false").alias("value")))
