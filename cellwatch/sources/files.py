"""Choose an input file in a folder, as a Spark job over the file listing.

The listing is a DataFrame (``binaryFile`` source, content column pruned), so
the choice is a filter plus a top-1 -- it works the same on a shared folder
with many files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Entries directly in ``folder`` (a plain file, or a folder of part files as Spark
    writes them), with name, path and newest modification time. Only ``*.csv``
    entries count; a ``key=value`` folder name counts by its value."""
    folder = folder.rstrip("/")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(folder).select("path", "modificationTime"))
    below = F.substring("path", len(whole) + 2, 1 << 20)            # what follows the folder
    entry = F.substring_index(below, "/", 1)
    name = F.regexp_replace(entry, "^[^=/]*=", "")
    return (files.withColumn("entry", entry).withColumn("name", name)
                 .filter(F.lower("name").endswith(".csv"))
                 .groupBy("entry", "name")
                 .agg(F.max(F.col("modificationTime").cast("timestamp_ntz")).alias("modified"))
                 .select(F.concat(F.lit(folder + "/"), F.col("entry")).alias("path"), "name", "modified"))


def newest_input(spark: SparkSession, folder: str) -> DataFrame:
    """Non-training files ordered by the date in their name (12-digit, else 8-digit
    prefix), else their modification time; newest first."""
    files = listing(spark, folder)
    stamped = files.filter(~F.lower("name").contains("train")).withColumn(
        "stamp", F.coalesce(S.filename_datetime("name"), F.col("modified")))
    return stamped.orderBy(F.col("stamp").desc(), F.col("name").desc())


def newest_input_path(spark: SparkSession, folder: str) -> str:
    top = newest_input(spark, folder).select("path").limit(1).collect()
    if not top:
        raise FileNotFoundError(f"{folder} holds no input CSV")
    return top[0]["path"]


def training_input(spark: SparkSession, folder: str) -> DataFrame:
    """Files whose name contains 'train' (any case), last by name first."""
    files = listing(spark, folder)
    return files.filter(F.lower("name").contains("train")).orderBy(F.col("name").desc())


def training_input_path(spark: SparkSession, folder: str) -> str:
    top = training_input(spark, folder).select("path").limit(1).collect()
    if not top:
        raise FileNotFoundError(f"{folder} holds no CSV named as training data")
    return top[0]["path"]
