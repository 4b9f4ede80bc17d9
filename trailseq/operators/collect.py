"""Event contexts to ``(user, history)`` rows. Plain column work: the same code serves batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the event format: the attribute codes of a reader, in fingerprint order.
ID_CODES = (4, 5, 6, 7, 15, 17, 47, 82)
INTEGER_CODES = (22, 141)
HISTORY_CODE = 145

MIN_HISTORY = 3


def map_value(map_path: str, key: int, default: int = 0) -> str:
    return f"coalesce(cast({map_path}[{key}] AS bigint), {default}L)"


def user_fingerprint(environment: str = "environment") -> Column:
    """Ten attributes in fixed order, 0 where missing. Readers who share all ten fall together."""
    ids = [map_value(f"{environment}.ids", code) for code in ID_CODES]
    integers = [map_value(f"{environment}.integers", code) for code in INTEGER_CODES]
    return F.expr(f"array({', '.join(ids + integers)})")


def possible_history(environment: str = "environment") -> Column:
    """The item list of the context, NULL when the context has none."""
    return F.expr(f"cast({environment}.lists[{HISTORY_CODE}] AS array<bigint>)")


def collect_histories(contexts: DataFrame, min_items: int = MIN_HISTORY) -> DataFrame:
    """Contexts with a history of at least ``min_items`` items as ``user``, ``history``."""
    return (
        contexts.select(user_fingerprint().alias("user"), possible_history().alias("history"))
        .where(F.size("history") >= min_items)
    )


def distinct_histories(collected: DataFrame) -> DataFrame:
    """One row per ``(user, history)``; also removes what a replayed batch wrote twice."""
    return collected.dropDuplicates(["user", "history"])


def last_per_key(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The last value per key in the given order (copies of a key are reduced before the shuffle)."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))
