"""Row identity does not depend on the cores alive when a scan is planned."""

from pyspark.sql import functions as F

from contrail.llm import jaccard
from contrail.llm.common import ROW, SPLITS, with_row

CORES = "spark.sql.leafNodeDefaultParallelism"


def test_ids_outlive_a_change_of_cores(spark, tmp_dir):
    spark.range(400).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text")).repartition(8).write.parquet(f"{tmp_dir}/docs")
    docs = spark.read.parquet(f"{tmp_dir}/docs")
    before = spark.conf.get(SPLITS, None)
    spark.conf.unset(SPLITS)
    try:
        spark.conf.set(CORES, "8")
        first = {r.doc_id: r[ROW] for r in with_row(docs).collect()}
        found = jaccard.classes(spark, docs)[1].where("keep").select("doc_id", ROW).collect()
        spark.conf.set(CORES, "1")
        assert {r.doc_id: r[ROW] for r in with_row(docs).collect()} == first
        assert [(r.doc_id, r[ROW]) for r in found] == [(0, first[0])]
        spark.conf.unset(SPLITS)  # scans planned by the cores alone do differ here
        assert {r.doc_id: r.id for r in docs.withColumn("id", F.monotonically_increasing_id()).collect()} != first
    finally:
        spark.conf.unset(CORES)
        if before:
            spark.conf.set(SPLITS, before)


def test_a_set_number_stays(spark):
    before = spark.conf.get(SPLITS, None)
    try:
        spark.conf.set(SPLITS, "3")
        with_row(spark.range(3))
        assert spark.conf.get(SPLITS) == "3"
    finally:
        spark.conf.set(SPLITS, before) if before else spark.conf.unset(SPLITS)
