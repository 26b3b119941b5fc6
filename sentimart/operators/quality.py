"""Data-quality reports and gates.

Each report is one aggregate pass over the table (conditional counts), turned into one row per
check. The result has a fixed, small number of rows, so a gate may collect it to decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sentimart import resources as R
from sentimart.functions import sentiment as SF


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def blank(c: str) -> Column:
    """F8: null or only spaces (TRIM removes spaces only, as in the reference's SQL)."""
    return F.col(c).isNull() | (F.trim(F.col(c), F.lit(" ")) == "")


def _rows(agg: DataFrame, checks: list[tuple[str, str, int, str]]) -> DataFrame:
    """Unpivot one aggregate row into (check, value, threshold, comparison, passed)."""
    items = []
    for name, col, threshold, cmp in checks:
        v = F.col(col).cast("long")
        ok = v >= threshold if cmp == ">=" else v <= threshold
        items.append(F.struct(
            F.lit(name).alias("check"), v.alias("value"), F.lit(threshold).cast("long").alias("threshold"),
            F.lit(cmp).alias("comparison"), ok.alias("passed")))
    return agg.select(F.inline(F.array(*items)))


def duplicates(df: DataFrame) -> DataFrame:
    """(app_name, review_id) groups with more than one row; null ids excluded."""
    return (df.filter(F.col("review_id").isNotNull())
            .groupBy("app_name", "review_id").agg(F.count(F.lit(1)).alias("dup_count"))
            .filter(F.col("dup_count") > 1))


def dq_report(df: DataFrame, as_of: str, check_rating: bool = True) -> DataFrame:
    """Q1: the five checks of the reference's validation job; warns only (passed flag)."""
    aggs = [
        count_if(blank("app_name")).alias("blank_app_name"),
        count_if(blank("review_text")).alias("blank_review_text"),
        count_if(F.col("review_ts") > F.lit(as_of).cast("timestamp_ntz")).alias("future_review_ts"),
    ]
    checks = [("blank_app_name", "blank_app_name", 0, "<="),
              ("blank_review_text", "blank_review_text", 0, "<=")]
    if check_rating:
        aggs.append(count_if((F.col("rating") < 1) | (F.col("rating") > 5)).alias("invalid_rating"))
        checks.append(("invalid_rating", "invalid_rating", 0, "<="))
    checks.append(("future_review_ts", "future_review_ts", 0, "<="))
    main = _rows(df.agg(*aggs), checks)
    dup = _rows(duplicates(df).agg(F.count(F.lit(1)).alias("duplicate_groups")),
                [("duplicate_review_id", "duplicate_groups", 0, "<=")])
    return main.unionByName(dup)


def raw_checks(min_rows: int = 100) -> dict[str, tuple[Column, str, int]]:
    """Q2: check -> (figure, comparison, threshold); every figure is a count, so runs add up."""
    return {
        "row_count": (F.count(F.lit(1)), ">=", min_rows),
        "null_app_name": (count_if(F.col("app_name").isNull()), "<=", 0),
        "null_rating": (count_if(F.col("rating").isNull()), "<=", 0),
        "null_review_text": (count_if(F.col("review_text").isNull()), "<=", 0),
        "rating_out_of_range": (count_if(~F.col("rating").between(1, 5)), "<=", 0),
    }


def processed_checks(min_rows: int = 50) -> dict[str, tuple[Column, str, int]]:
    """Q3: row count, nulls in cleaned text / score, score range, label agrees with score."""
    s = F.col("sentiment_score")
    return {
        "row_count": (F.count(F.lit(1)), ">=", min_rows),
        "null_cleaned_text": (count_if(F.col("cleaned_text").isNull()), "<=", 0),
        "null_score": (count_if(s.isNull()), "<=", 0),
        "score_out_of_range": (count_if((s < -1.0) | (s > 1.0)), "<=", 0),
        "label_mismatch": (count_if(s.isNotNull() & (F.col("sentiment") != SF.sentiment_label(s))), "<=", 0),
        "label_not_in_domain": (count_if(~F.col("sentiment").isin(*R.SENTIMENT_LABELS)), "<=", 0),
    }


def _report(figures: DataFrame, checks: dict[str, tuple[Column, str, int]]) -> DataFrame:
    return _rows(figures, [(name, name, threshold, cmp) for name, (_, cmp, threshold) in checks.items()])


def _figures(df: DataFrame, checks: dict[str, tuple[Column, str, int]]) -> DataFrame:
    return df.agg(*[column.alias(name) for name, (column, _, _) in checks.items()])


def _duplicate_report(df: DataFrame) -> DataFrame:
    return _rows(duplicates(df).agg(F.count(F.lit(1)).alias("d")), [("duplicate_review_id", "d", 0, "<=")])


def dq_gate_raw(df: DataFrame, min_rows: int = 100) -> DataFrame:
    """Q2: row count threshold, nulls in key columns, rating range, duplicate ids."""
    checks = raw_checks(min_rows)
    return _report(_figures(df, checks), checks).unionByName(_duplicate_report(df))


def dq_gate_processed(df: DataFrame, min_rows: int = 50) -> DataFrame:
    """Q3 over a whole table."""
    checks = processed_checks(min_rows)
    return _report(_figures(df, checks), checks)


#: Figures stored beside each run's rows.
RAW_METRICS, PROCESSED_METRICS = "raw", "processed"
_CHECKS = {RAW_METRICS: raw_checks, PROCESSED_METRICS: processed_checks}


def write_observed(df: DataFrame, kind: str, path: str, metrics_path: str) -> dict[str, int]:
    """Write a run's rows; the gate's figures are observed on the way and stored as one row at ``metrics_path``."""
    spark = df.sparkSession
    checks = _CHECKS[kind]()
    seen = Observation()
    df.observe(seen, *[column.alias(name) for name, (column, _, _) in checks.items()]).write.mode("overwrite").parquet(path)
    figures = {name: int(seen.get[name]) for name in checks}
    row = spark.createDataFrame([tuple(figures.values())], ", ".join(f"{name} long" for name in checks))
    row.coalesce(1).write.mode("overwrite").parquet(metrics_path)
    return figures


def gate_of_runs(spark: SparkSession, kind: str, metrics_root: str, new_rows: DataFrame | None = None, min_rows: int | None = None) -> DataFrame:
    """Q2/Q3 from the stored figures of all runs: the report of the whole table, without reading it.

    ``new_rows``: the rows of the newest run, the only ones that are read, for duplicate ids. Older runs were checked when
    they were new, and no run stores an id that another one has (insert-or-ignore).
    """
    checks = _CHECKS[kind]() if min_rows is None else _CHECKS[kind](min_rows)
    runs = spark.read.schema(", ".join(f"{name} long" for name in checks)).parquet(metrics_root)
    report = _report(runs.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in checks]), checks)
    return report if new_rows is None else report.unionByName(_duplicate_report(new_rows))


class GateFailed(ValueError):
    pass


def enforce(report: DataFrame) -> DataFrame:
    """Raise when a gate check fails (the report has a fixed handful of rows)."""
    failed = [r["check"] for r in report.filter(~F.col("passed")).select("check").collect()]
    if failed:
        raise GateFailed(f"data-quality gate failed: {', '.join(failed)}")
    return report
