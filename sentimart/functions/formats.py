"""Display formats of the dashboard (X19) and type coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fmt_fixed(c: Column, places: int) -> Column:
    """Number with a fixed count of decimals; null -> 'N/A'."""
    return F.coalesce(F.format_string(f"%.{places}f", c), F.lit("N/A"))


def fmt_date(c: Column) -> Column:
    """Date as %Y-%m-%d; null -> 'N/A'."""
    return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("N/A"))


def try_double(c: Column) -> Column:
    """Bad number -> null (ANSI mode would raise on a plain cast)."""
    return c.try_cast("double")


def try_timestamp(c: Column) -> Column:
    """Bad timestamp -> null."""
    return c.try_cast("timestamp_ntz")


def year_month(ts: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(ts.cast("date"), "month")


def fmt_share(c: Column) -> Column:
    """Percentage with one decimal; null -> 'N/A'."""
    return F.coalesce(F.concat(F.round(c.cast("decimal(18,6)"), 1).cast("string"), F.lit("%")), F.lit("N/A"))


def fmt_mean(c: Column) -> Column:
    """Mean with two decimals; null -> 'N/A'."""
    return F.coalesce(F.round(c.cast("decimal(18,6)"), 2).cast("string"), F.lit("N/A"))


def example_title(rating: Column, score: Column, ts: Column, unscored: Column) -> Column:
    """Header of an example; `unscored` examples are shown without a score."""
    shown = F.when(unscored, F.lit("")).otherwise(F.concat(F.lit(" | VADER Score: "), fmt_fixed(score, 3)))
    return F.concat(F.lit("Rating: "), F.coalesce(rating.cast("string"), F.lit("N/A")), F.lit(" ⭐"), shown, F.lit(" | Date: "), fmt_date(ts))
