"""Loaders of the public resource files, as tables for ``operators.process.TextResources``.

The files are not part of the repository; each loader reads one public format with Spark, at any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def vader_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(token, valence) of a VADER lexicon file: token, mean valence, deviation and ratings, parted by tabs."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).select(F.get(parts, F.lit(0)).alias("token"), F.get(parts, F.lit(1)).try_cast("double").alias("valence"))
    return rows.filter("token <> '' and valence is not null")


def exceptions(spark: SparkSession, path: str) -> DataFrame:
    """(token, lemma) of a WordNet exception list (``noun.exc``): a form and its base forms; the first counts."""
    parts = F.split(F.trim("value"), " +")
    rows = spark.read.text(path).select(F.get(parts, F.lit(0)).alias("token"), F.get(parts, F.lit(1)).alias("lemma"))
    return rows.filter("token <> '' and lemma is not null and not contains(token, '_')")


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(token) of a WordNet index file (``index.noun``): the first field of each line; licence lines begin with blanks."""
    rows = spark.read.text(path).filter("not startswith(value, ' ')").select(F.split("value", " ")[0].alias("token"))
    return rows.filter("token <> '' and not contains(token, '_')").distinct()


def words(spark: SparkSession, path: str) -> DataFrame:
    """(token) of a plain list, one word a line (negators, stopwords)."""
    return spark.read.text(path).select(F.trim("value").alias("token")).filter("token <> ''")


def boosters(spark: SparkSession, path: str) -> DataFrame:
    """(token, scalar) of a list with a tab between word and scalar."""
    return vader_lexicon(spark, path).withColumnRenamed("valence", "scalar")


def phrases(spark: SparkSession, path: str) -> DataFrame:
    """(phrase, valence) of a list with a tab between phrase and valence."""
    return vader_lexicon(spark, path).withColumnRenamed("token", "phrase")
