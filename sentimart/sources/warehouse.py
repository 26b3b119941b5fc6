"""Tables in Spark's catalog: ensure-table, one-run commits and bucketed id tables.

``Warehouse`` keeps the raw, processed and watermark tables in one schema of the session's catalog, each
partitioned by the run (``batch``) that wrote it, and beside raw and processed an id table:

* ``ensure`` creates what is missing (``CREATE TABLE IF NOT EXISTS``) and leaves the rest alone;
* a run writes its own partition only, by dynamic partition overwrite, and reads the tables without it, so a
  replay after a failure gives the same tables (S11). Keys and ranges are enforced on the way in
  (``ingest.insert_or_ignore``); what breaks them goes to the rejects table with its reason;
* the id tables are bucketed by their key. A batch's keys are dealt to the same buckets and meet the stored ones
  where they lie: the stored side of the anti join has no exchange, however large it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimart import schemas as S
from sentimart.operators import ingest as I
from sentimart.streaming.ingest import path_exists

REJECTS = T.StructType([T.StructField("app_name", T.StringType()), T.StructField("raw_id", T.LongType()), T.StructField("reason", T.StringType())])


class Warehouse:
    """Review tables in ``schema`` of the session's catalog; files under ``root`` (a shared folder)."""

    def __init__(self, spark: SparkSession, schema: str, root: str, buckets: int = 64):
        self.spark, self.schema, self.root, self.buckets = spark, schema, root.rstrip("/"), buckets

    def name(self, table: str) -> str:
        return f"`{self.schema}`.`{table}`"

    def _create(self, table: str, columns: T.StructType, bucket_key: str | None = None) -> None:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL") for f in columns)
        clustered = f"CLUSTERED BY ({bucket_key}) SORTED BY ({bucket_key}) INTO {self.buckets} BUCKETS" if bucket_key else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({fields}, batch BIGINT) USING parquet "
                       f"PARTITIONED BY (batch) {clustered} LOCATION '{self.root}/{table}'")

    def ensure(self) -> "Warehouse":
        """Schema and tables, created if missing; partitions that lie in the folder are found again."""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{self.schema}` LOCATION '{self.root}'")
        known = {r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN `{self.schema}`").collect()}
        review_id = T.StructType([T.StructField("review_id", T.StringType())])
        raw_id = T.StructType([T.StructField("raw_id", T.LongType())])
        for table, columns, key in (("raw", S.RAW, None), ("processed", S.PROCESSED, None), ("watermarks", S.WATERMARKS, None),
                                    ("rejects", REJECTS, None), ("raw_ids", review_id, "review_id"),
                                    ("processed_ids", review_id, "review_id"), ("processed_raw_ids", raw_id, "raw_id")):
            self._create(table, columns, key)
            if table not in known and path_exists(self.spark, f"{self.root}/{table}"):
                self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)}")
        return self

    def read(self, table: str, without: int | None = None) -> DataFrame:
        df = self.spark.table(self.name(table))
        return (df if without is None else df.filter(F.col("batch") != without)).drop("batch")

    def replace(self, table: str, rows: DataFrame, batch: int) -> None:
        """The batch's partition holds exactly these rows afterwards; other partitions are not touched."""
        columns = [c for c in self.spark.table(self.name(table)).columns if c != "batch"]
        view = f"_sentimart_{table}_{batch}"
        rows.select(*columns).createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.name(table)} PARTITION (batch = {int(batch)}) SELECT {', '.join(f'`{c}`' for c in columns)} FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def unseen(self, rows: DataFrame, ids: str, key: str, batch: int) -> DataFrame:
        """Rows whose non-null key no other batch stored. The id table is read where its buckets lie."""
        stored = self.read(ids, without=batch).select(key)
        # A shuffled join also for small batches: a broadcast of the stored side would grow with the table.
        return rows.join(stored.hint("merge"), key, "left_anti")

    def insert_raw(self, rows: DataFrame, batch: int) -> None:
        """INSERT OR IGNORE of raw-shaped rows, then their ids, rejects and watermarks."""
        first = I.insert_or_ignore(None, rows)
        self.replace("raw", self.unseen(first, "raw_ids", "review_id", batch), batch)
        mine = self.spark.table(self.name("raw")).filter(F.col("batch") == batch)
        self.replace("raw_ids", mine.select("review_id").filter("review_id is not null"), batch)
        rejects = I.constraint_rejects(rows).filter("reason <> 'duplicate_review_id'")
        self.replace("rejects", rejects, batch)
        self.replace("watermarks", I.watermarks_from(rows), batch)

    def insert_processed(self, batch: int, resources=None) -> None:
        """Process the raw rows that have no processed row yet; both keys are checked by their id tables."""
        from sentimart.operators import process as P

        raw = P.valid_for_processed(self.read("raw"))
        ids = I.first_arrivals(raw.select("raw_id", "review_id"))
        ids = self.unseen(self.unseen(ids, "processed_raw_ids", "raw_id", batch), "processed_ids", "review_id", batch)
        todo = raw.join(ids.select("raw_id"), "raw_id", "left_semi")
        self.replace("processed", P.process_reviews(todo, resources), batch)
        mine = self.spark.table(self.name("processed")).filter(F.col("batch") == batch)
        self.replace("processed_raw_ids", mine.select("raw_id"), batch)
        self.replace("processed_ids", mine.select("review_id").filter("review_id is not null"), batch)

    def watermarks(self, without: int | None = None) -> DataFrame:
        return self.read("watermarks", without).groupBy("app_name").agg(F.max("last_ts").alias("last_ts"))
