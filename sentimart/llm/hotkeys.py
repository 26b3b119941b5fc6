"""Joins of a large table with one row per key where a few keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys with at least one in so many of all rows are heavy; there are at most so many of them.
HEAVY = 1000


def join_heavy(rows: DataFrame, table: DataFrame, key: str, n_rows: str, total: int) -> DataFrame:
    """rows left join table on key; table has one row per key and counts the key's rows in n_rows, total of them in all.

    At most HEAVY keys can hold 1 / HEAVY of the rows each, so the table of these is bounded and broadcast: their rows do not
    move. The other keys are joined by a shuffle in which no key has more than 1 / HEAVY of the rows. Null keys get nulls.
    """
    value = [c for c in table.columns if c not in (key, n_rows)]
    is_heavy = F.col(n_rows) * HEAVY >= max(total, 1)
    heavy = table.filter(is_heavy).select(key, *value, F.lit(True).alias("__heavy"))
    marked = rows.join(F.broadcast(heavy), key, "left")
    done = marked.filter(F.col("__heavy") | F.col(key).isNull()).drop("__heavy")
    rest = marked.filter(F.col("__heavy").isNull() & F.col(key).isNotNull()).select(*rows.columns)
    light = table.filter(~is_heavy).select(key, *value)
    return done.unionByName(rest.join(light, key, "left").select(*done.columns))
