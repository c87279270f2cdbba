"""Structured Streaming ingest: message bytes → typed rows → append sink.

The reference reads a Kafka topic of JSON documents, parses them with a
fixed schema and appends them to the bronze table every 30 seconds with a
checkpoint. Here the source is pluggable (``kafka`` when the connector is on
the classpath; ``text``/``json``/``parquet`` file streams offline), parsing
is built-in ``from_json`` (no Python in the hot path), malformed messages can
be split to a quarantine sink, and duplicates can be dropped within a
watermark.
"""

from __future__ import annotations

import os
import time
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

CORRUPT = "_corrupt_record"

# Message shapes of the two topics (all strings on the wire; times are ISO-8601).
USER_EVENT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ["event_ts", "user_id", "name", "country"]])
FLIGHT_EVENT_SCHEMA = T.StructType([
    T.StructField("flight_id", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("scheduled_departure", T.StringType()),
    T.StructField("scheduled_arrival", T.StringType()),
    T.StructField("max_passenger_capacity", T.IntegerType()),
])

# Micro-batches every 30 s.
DEFAULT_TRIGGER = "30 seconds"
#: Folders of a deduplicated target: the event day, and the micro-batch that wrote a row. Not columns of the table.
DAY, BATCH = "_event_date", "_batch"
FRESH = "_fresh"
#: Events come up to 48 hours late.
DEFAULT_DELAY = "48 hours"
#: State outside the heap; a batch saves its changes, not the whole state.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def stream_source(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                  schema: T.StructType | None = None, per_trigger: int | None = None, **options) -> DataFrame:
    """An unbounded DataFrame with a ``value`` column (or ``schema`` columns).

    ``kafka``: options ``bootstrap`` and ``topic`` default to the
    ``KAFKA_BOOTSTRAP`` / ``KAFKA_TOPIC`` environment variables, as in the
    reference; needs the spark-sql-kafka package at submit time.
    ``text``: one message per line under ``path`` (``value`` column).
    ``json``/``parquet``/``rate``: the matching built-in file/test sources.
    ``per_trigger`` bounds a micro-batch: messages (kafka) or files.
    """
    reader = spark.readStream
    if per_trigger is not None:
        options["maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger"] = str(per_trigger)
    if fmt == "kafka":
        bootstrap = options.pop("bootstrap", os.environ.get("KAFKA_BOOTSTRAP", "kafka:9092"))
        topic = options.pop("topic", os.environ.get("KAFKA_TOPIC", "raw_users"))
        reader = reader.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("subscribe", topic)
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.load()
    for k, v in options.items():
        reader = reader.option(k, v)
    if fmt == "text":
        return reader.text(path)
    if fmt == "rate":
        return reader.format("rate").load()
    if schema is None:
        raise ValueError(f"{fmt} stream needs a schema")
    return reader.schema(schema).format(fmt).load(path)


def _parse_ts(c, ts_type: str):
    if ts_type == "timestamp_ntz":
        return F.col(c).try_cast("timestamp_ntz")  # wall clock as written; a zone suffix is ignored
    return F.try_to_timestamp(F.col(c))  # instant; NULL (not an error) on bad text


def parse_json_events(df: DataFrame, schema: T.StructType, ts_cols: Sequence[str] = (),
                      ts_type: str = "timestamp", keep_raw: bool = False) -> DataFrame:
    """bytes/string ``value`` → typed columns (PERMISSIVE).

    A malformed message becomes an all-NULL row (the reference behaviour);
    ``_corrupt_record`` keeps its text and ``_bad_ts`` flags a timestamp
    that was present but did not parse. Both helper columns are kept only
    with ``keep_raw=True`` (used to split off bad records).
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    raw = df.select(F.col("value").cast("string").alias("_raw"))
    parsed = raw.select("_raw", F.from_json("_raw", full, {"mode": "PERMISSIVE",
                                                           "columnNameOfCorruptRecord": CORRUPT}).alias("d"))
    cols = [F.col(f"d.{f.name}").alias(f.name) for f in schema.fields]
    out = parsed.select("_raw", *cols, F.col(f"d.{CORRUPT}").alias(CORRUPT))
    bad_ts = F.lit(False)
    for c in ts_cols:
        bad_ts = bad_ts | (F.col(c).isNotNull() & _parse_ts(c, ts_type).isNull())
    out = out.withColumn("_bad_ts", bad_ts).withColumns({c: _parse_ts(c, ts_type) for c in ts_cols})
    if keep_raw:
        return out
    return out.drop("_raw", CORRUPT, "_bad_ts")


def split_bad_records(parsed_raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) from ``parse_json_events(keep_raw=True)``.

    Quarantine rows keep the raw text and a reason: ``malformed`` (not JSON
    for the schema) or ``bad_timestamp``.
    """
    is_bad = F.col(CORRUPT).isNotNull() | F.col("_bad_ts")
    good = parsed_raw.where(~is_bad).drop("_raw", CORRUPT, "_bad_ts")
    bad = parsed_raw.where(is_bad).select(
        F.col("_raw").alias("value"),
        F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed")).otherwise(F.lit("bad_timestamp")).alias("reason"))
    return good, bad


def _with_settings(spark: SparkSession, settings: dict[str, str], start):
    """``start()`` with session settings that only the query started there sees."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def held_keys(spark: SparkSession, target: str, days: Sequence[str], schema: T.StructType, but: int) -> DataFrame | None:
    """Rows that the target holds of the given event days, batch ``but`` left out; None if it has none of these days.

    Only the folders of these days are listed and read.
    """
    files = spark._jvm.org.apache.hadoop.fs
    root = files.Path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    there = [p for p in (f"{target}/{DAY}={day}" for day in days) if root.exists(files.Path(p))]
    if not there:
        return None
    typed = T.StructType([*schema.fields, T.StructField(DAY, T.DateType()), T.StructField(BATCH, T.LongType())])
    return spark.read.schema(typed).option("basePath", target).parquet(*there).where(F.col(BATCH) != but)


def ingest_distinct(df: DataFrame, target: str, checkpoint: str, keys: Sequence[str], event_time: str,
                    trigger: str = DEFAULT_TRIGGER, delay: str = DEFAULT_DELAY) -> StreamingQuery:
    """Append the messages of ``df`` whose key was not seen before, however late they come.

    Keys of the last ``delay`` of event time are kept in the state store (RocksDB, so not in the heap), which
    ages them out; repeats of these never touch the target. A message later than the watermark is not dropped:
    it is looked up in the target, in the folder of its event day alone. ``keys`` must hold ``event_time``: a
    repeat carries the time of the first delivery.

    Every batch is written once in the checkpoint folder (the state must not be run twice), then to folders
    ``_event_date=<day>/_batch=<id>`` that a replayed batch overwrites: every key is kept exactly once. Rows
    with a NULL key or event time cannot be told apart and are all kept.
    """
    if event_time not in keys:
        raise ValueError(f"the key must hold the event time {event_time}: {list(keys)}")
    spark = df.sparkSession
    # an empty first folder, so that the target can be read from the first batch on
    spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{target}/{DAY}=__HIVE_DEFAULT_PARTITION__/{BATCH}=-1")
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    fresh = df.withWatermark(event_time, delay).where(whole).dropDuplicatesWithinWatermark(list(keys))
    both = fresh.withColumn(FRESH, F.lit(True)).unionByName(df.withColumn(FRESH, F.lit(False)))
    running: list[StreamingQuery] = []

    def horizon(batch_id: int) -> str | None:
        """The watermark below which this batch's rows were late; None if unknown, as in the first batch after a start."""
        last = running[0].lastProgress if running else None
        known = last and last["batchId"] == batch_id - 1 and last.get("eventTime", {}).get("watermark")
        return known or None

    def merge(batch: DataFrame, batch_id: int) -> None:
        here, staged = batch.sparkSession, f"{checkpoint.rstrip('/')}/staged/{batch_id % 2}"
        batch.write.mode("overwrite").parquet(staged)
        rows = here.read.schema(batch.schema).parquet(staged)
        first, every = rows.where(FRESH).drop(FRESH), rows.where(~F.col(FRESH)).drop(FRESH)
        # what is neither new to the state nor late is a repeat
        late, limit = every.where(whole), horizon(batch_id)
        if limit:
            late = late.where(F.col(event_time) <= F.lit(limit).cast("timestamp"))
        late = late.join(first.select(*keys), list(keys), "left_anti").dropDuplicates(list(keys)).select(*df.columns)
        days = [r.day for r in late.select(F.to_date(event_time).cast("string").alias("day")).distinct().collect()]
        held = held_keys(here, target, days, df.schema, batch_id) if days else None
        if held is not None:
            late = late.join(held.select(*keys), list(keys), "left_anti").select(*df.columns)
        out = first.unionByName(every.where(~whole))
        out = (out.unionByName(late) if days else out).withColumns({DAY: F.to_date(event_time), BATCH: F.lit(batch_id)})
        # few files to a day, a hot day split
        out.hint("rebalance", F.col(DAY)).write.partitionBy(DAY, BATCH).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(target)

    w = both.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger == "available_now" else w.trigger(processingTime=trigger)
    running.append(_with_settings(spark, STATE_STORE, w.start))
    return running[0]


def ingest_stream(df: DataFrame, target: str, checkpoint: str, trigger: str = DEFAULT_TRIGGER,
                  fmt: str = "parquet", partition_by: Sequence[str] = (), query_name: str | None = None) -> StreamingQuery:
    """Append ``df`` to ``target`` with a checkpoint (exactly-once file sink).

    ``trigger`` is a processing-time interval, or ``"available_now"`` to
    drain what is there and stop (batch-style runs and tests). A restart
    resumes from the checkpoint without duplicating committed batches.
    """
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", target))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if trigger == "available_now" else w.trigger(processingTime=trigger)
    return w.start()


def ingest_json_topic(spark: SparkSession, source: DataFrame, schema: T.StructType, ts_cols: Sequence[str],
                      target: str, checkpoint: str, trigger: str = DEFAULT_TRIGGER, ts_type: str = "timestamp",
                      quarantine: str | None = None, dedup_keys: Sequence[str] | None = None) -> list[StreamingQuery]:
    """Source → parse → (dedupe) → bronze sink, plus an optional quarantine sink.

    With ``quarantine`` set, bad records go to their own sink (second query
    with its own checkpoint, so each sink stays exactly-once); otherwise
    they are appended as all-NULL rows like the reference does.
    """
    parsed = parse_json_events(source, schema, ts_cols, ts_type, keep_raw=True)
    queries = []
    if quarantine:
        good, bad = split_bad_records(parsed)
        queries.append(ingest_stream(bad, quarantine, checkpoint.rstrip("/") + "_quarantine", trigger))
    else:
        good = parsed.drop("_raw", CORRUPT, "_bad_ts")
    queries.insert(0, ingest_distinct(good, target, checkpoint, dedup_keys, ts_cols[0], trigger) if dedup_keys
                   else ingest_stream(good, target, checkpoint, trigger))
    return queries


def stop_cleanly(query: StreamingQuery, timeout: float = 600.0) -> None:
    """Stop a long-running query between two micro-batches: the batch that runs is finished first, so a restart begins
    with new offsets. A query whose batches follow each other without a pause is stopped after ``timeout`` seconds."""
    until = time.monotonic() + timeout
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.05)
    query.stop()


def progress_rows(query: StreamingQuery) -> list[tuple[int, int, int]]:
    """(batch, rows read, milliseconds taken) of the query's recent micro-batches that had data: how far it lags."""
    return [(p["batchId"], p["numInputRows"], p["durationMs"].get("triggerExecution", 0)) for p in query.recentProgress if p["numInputRows"]]


def run_to_completion(queries: Sequence[StreamingQuery]) -> None:
    """Wait for ``available_now`` queries to finish, however long they take; re-raise any failure."""
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def ingest_user_events(spark: SparkSession, layout, source: DataFrame | None = None,
                       trigger: str = DEFAULT_TRIGGER, quarantine: bool = False,
                       dedup: bool = False) -> list[StreamingQuery]:
    """T2 end to end: the user-event topic into bronze ``events_raw``.

    Source defaults to Kafka (``KAFKA_BOOTSTRAP`` / ``KAFKA_TOPIC``); the sink
    and its checkpoint live under the layout's bronze folder, so a restart on
    any machine resumes from the same offsets. ``quarantine`` splits bad
    messages to ``events_raw_quarantine``; ``dedup`` drops repeats of a
    whole message and keeps every other one, however late: two messages may
    share a user and a second.
    """
    src = source if source is not None else stream_source(spark, "kafka")
    target = layout.path("bronze", "events_raw")
    return ingest_json_topic(
        spark, src, USER_EVENT_SCHEMA, ["event_ts"], target, layout.path("bronze", "_checkpoints/events_raw"),
        trigger=trigger, quarantine=layout.path("bronze", "events_raw_quarantine") if quarantine else None,
        dedup_keys=USER_EVENT_SCHEMA.names if dedup else None)
