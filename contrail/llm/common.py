"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Row identity inside one operator: its value follows from the scan (file split and offset),
#: so a recomputed task gives the same ids. Operators that read a few columns select them first;
#: those that return whole documents put columns of clashing names aside (``own_names``).
ROW = "__llm_row"
SPLITS = "spark.sql.files.minPartitionNum"


#: Arrow batches of whole texts: unless set smaller, rows and bytes that a task hands to Python at once.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hand texts to Python in small batches: a batch lies in memory several times over, on both
    sides, and no heap setting bounds it."""
    before = {k: spark.conf.get(k, None) for k in BATCHES}
    for k, most in BATCHES.items():
        digits = str(before[k] or "").lower().removesuffix("b")
        if not (digits.isdigit() and 0 < int(digits) < most):
            spark.conf.set(k, str(most))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pin_splits(spark: SparkSession) -> None:
    """Split files alike for the rest of the session.

    Unless a number is set, a scan is split by the cores alive when it is planned. An executor lost or
    won between two scans of a table would then give its rows other ids in the second one.
    """
    if not spark.conf.get(SPLITS, None):
        cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
        spark.conf.set(SPLITS, str(cores))


def with_row(df: DataFrame) -> DataFrame:
    """``df``, a scan of files or of a written table, with the identity of each row."""
    pin_splits(df.sparkSession)
    return df.withColumn(ROW, F.monotonically_increasing_id())


def own_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators ``(spark, docs, ...)`` that return the columns of ``docs``: input columns that begin with two
    underscores, as the operators' own do, go by other names while it runs."""
    @wraps(operator)
    def run(spark: SparkSession, docs: DataFrame, *args, **options) -> DataFrame:
        taken = {c.lower() for c in docs.columns}
        aside = {}
        for c in docs.columns:
            if c.startswith("__"):
                safe = f"aside_{len(aside)}"
                while safe in taken:
                    safe += "_"
                taken.add(safe)
                aside[c] = safe
        if not aside:
            return operator(spark, docs, *args, **options)
        return operator(spark, docs.withColumnsRenamed(aside), *args, **options).withColumnsRenamed({safe: c for c, safe in aside.items()})
    return run


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def carry(df: DataFrame, own: tuple[str, ...] = ()) -> tuple[list, dict[str, str]]:
    """Columns of ``df`` but ``own`` under safe names, and the mapping back to their names."""
    names = [c for c in df.columns if c not in own]
    back = {f"__c{i}": c for i, c in enumerate(names)}
    return [df[c].alias(safe) for safe, c in back.items()], back
