"""Fitted models and datasets on a (shared) file system.

Spark ML persistence replaces the pickle format; any Hadoop-compatible URI
(a shared folder, an object store) works for publishing and fetching, which
re-aims the original's cloud-drive client.

A published model is a new version beside the old ones::

    <folder>/<name>/versions/<version>/     the model, written completely first
    <folder>/<name>/published/<version>     an empty file, renamed into place last

The newest name in ``published`` is the model, so a scorer that loads while another is
published gets the old one or the new one, never a half-written one. Nothing is overwritten.
"""

from __future__ import annotations

import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from .csv import read_csv_tolerant

MODEL_NAME = "battery_risk_model"
KEEP = 5                 # published versions that stay; a scorer may still be reading the last ones


def save_model(model: PipelineModel, path: str) -> str:
    """Write, replacing a model of the same path."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Load a saved model, or the newest version of a published one, with a clear error when no
    model was trained yet."""
    spark = SparkSession.builder.getOrCreate()
    names = published_versions(spark, path)
    while True:
        try:
            return PipelineModel.load(f"{path.rstrip('/')}/versions/{names[-1]}" if names else path)
        except Exception as ex:
            before, names = names, published_versions(spark, path)
            if names and names[-1:] != before[-1:]:
                continue                       # newer versions came, and this one went meanwhile
            if "does not exist" in str(ex) or "PATH_NOT_FOUND" in str(ex) or "InvalidInputException" in str(ex):
                raise FileNotFoundError(f"no saved model at {path}") from ex
            raise


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and a way to make its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def published_versions(spark: SparkSession, path: str) -> list[str]:
    """Versions of the model published at ``path``, oldest first."""
    fs, make = _files(spark, path)
    folder = make(f"{path.rstrip('/')}/published")
    if not fs.exists(folder):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return sorted(n for n in names if not n.startswith(("_", ".")))


def publish_model(model: PipelineModel, folder: str, name: str = MODEL_NAME, keep: int = KEEP) -> str:
    """Publish a new version of ``name`` in a shared folder; returns the path to load.

    The last ``keep`` versions stay (two at least, for scorers that are loading).
    """
    spark = SparkSession.builder.getOrCreate()
    path = f"{folder.rstrip('/')}/{name}"
    fs, make = _files(spark, path)
    before = published_versions(spark, path)
    stamp = time.time_ns() // 1000
    if before:
        stamp = max(stamp, int(before[-1].split("-")[0]) + 1)        # newer than any, whatever the clocks say
    version = f"{stamp:020d}-{uuid.uuid4().hex[:8]}"
    model.save(f"{path}/versions/{version}")
    waiting = make(f"{path}/published/_{version}")
    fs.create(waiting, True).close()
    if not fs.rename(waiting, make(f"{path}/published/{version}")):
        raise OSError(f"could not publish {path}")
    for old in before[:max(0, len(before) + 1 - max(keep, 2))]:
        fs.delete(make(f"{path}/published/{old}"), False)
        fs.delete(make(f"{path}/versions/{old}"), True)
    return path


def fetch_dataset(spark: SparkSession, folder: str, filename: str) -> DataFrame:
    """A named dataset from a shared folder, read tolerantly."""
    return read_csv_tolerant(spark, f"{folder.rstrip('/')}/{filename}")
