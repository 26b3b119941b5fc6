"""Score normalisation and labels (X12, X13 second half)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentimart import resources as R


def compound(valence_sum: Column) -> Column:
    """Sum of valences -> compound score in [-1, 1], rounded to 4 places; no hit -> 0.0."""
    s = F.coalesce(valence_sum, F.lit(0.0))
    norm = s / F.sqrt(s * s + F.lit(R.VADER_ALPHA))
    return F.round(F.least(F.greatest(norm, F.lit(-1.0)), F.lit(1.0)), 4)


def sentiment_label(score: Column) -> Column:
    """>= 0.05 Positive, <= -0.05 Negative, else Neutral (null score -> Neutral)."""
    return (
        F.when(score >= R.POSITIVE_THRESHOLD, F.lit("Positive"))
        .when(score <= R.NEGATIVE_THRESHOLD, F.lit("Negative"))
        .otherwise(F.lit("Neutral"))
    )
