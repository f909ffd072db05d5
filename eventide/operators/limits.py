"""Daily click limit per user and ad, with one warning when it is passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.times import utc_day
from eventide.operators.ranking import first_n

PASSED = "passed"
WARNING = "warning"


def warning_text(limit: int) -> str:
    """Message of the warning raised by click ``limit + 1``."""
    return f"Click over {limit} times today."


def total_order(columns: Sequence[str], order: Sequence[str] | None, ts: str = "ts") -> list[str]:
    """``order``, or else the time; then all other columns, so that only equal rows are interchangeable."""
    first = list(order or [ts])
    return first + [c for c in columns if c not in first]


def click_limit(
    clicks: DataFrame,
    limit: int,
    order: Sequence[str] | None = None,
    keys: Sequence[str] = ("user_id", "ad_id"),
    ts: str = "ts",
) -> DataFrame:
    """Clicks with ``kind``: the first ``limit`` of a key and UTC day are ``passed``,
    the next one becomes the day's ``warning``, the rest is dropped.

    Only ``limit + 1`` rows of a key and day are ever needed, so a user hammering
    one ad is cut down before the exchange. Clicks count by ``order`` (time, if not
    given); ties are broken by the remaining columns, so results are repeatable.
    """
    dated = clicks.withColumn("day", utc_day(F.col(ts)))
    kept = first_n(dated, [*keys, "day"], total_order(clicks.columns, order, ts), limit + 1, rank="nth")
    kind = F.when(F.col("nth") <= limit, PASSED).otherwise(WARNING)
    return kept.withColumn("kind", kind).drop("nth", "day")


def passed_clicks(tagged: DataFrame) -> DataFrame:
    """Main output."""
    return tagged.where(F.col("kind") == PASSED).drop("kind")


def blacklist_warnings(tagged: DataFrame, limit: int) -> DataFrame:
    """Side output: ``user_id, ad_id, msg``."""
    return tagged.where(F.col("kind") == WARNING).select(
        "user_id", "ad_id", F.lit(warning_text(limit)).alias("msg")
    )
