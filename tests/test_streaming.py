"""Streaming tier: JSON file source + available_now + checkpoint."""

import os

from pyspark.sql import functions as F

from contrail.streaming import ingest

MSGS = [
    '{"event_ts":"2024-01-01T10:00:00Z","user_id":"u1","name":"a","country":"FR"}',
    '{"event_ts":"2024-01-01T10:00:00Z","user_id":"u1","name":"a","country":"FR"}',  # exact duplicate
    '{"event_ts":"2024-01-03T09:00:00Z","user_id":"u2","name":"b","country":"DE"}',
    '{"event_ts":"2024-01-01T10:00:05Z","user_id":"u3","name":"c","coun',  # malformed
    '{"event_ts":"not a time","user_id":"u4","name":"d","country":"IL"}',  # bad timestamp
    '{"event_ts":"2024-01-02T10:00:00Z","user_id":7,"name":"e"}',  # number for string, missing field
]


def _write(spark, path, lines):
    spark.createDataFrame([(m,) for m in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_keep_mode_appends_all_null_rows_and_restart_does_not_duplicate(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    _write(spark, src, MSGS)
    out, chk = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "chk")
    for _ in range(2):  # second run finds nothing new in the checkpoint
        qs = ingest.ingest_json_topic(spark, ingest.stream_source(spark, "text", path=src), ingest.USER_EVENT_SCHEMA,
                                      ["event_ts"], out, chk, trigger="available_now")
        ingest.run_to_completion(qs)
    df = spark.read.parquet(out)
    assert df.count() == len(MSGS)
    assert df.where(F.col("user_id").isNull()).count() == 1  # malformed -> all-NULL row
    assert df.where(F.col("user_id") == "7").count() == 1  # number coerced to string
    assert df.where(F.col("user_id") == "u4").first().event_ts is None
    # new data after a restart is picked up exactly once
    _write(spark, src, ['{"event_ts":"2024-01-04T00:00:00Z","user_id":"u9","name":"z","country":"FR"}'])
    ingest.run_to_completion(ingest.ingest_json_topic(
        spark, ingest.stream_source(spark, "text", path=src), ingest.USER_EVENT_SCHEMA, ["event_ts"], out, chk,
        trigger="available_now"))
    assert spark.read.parquet(out).count() == len(MSGS) + 1


def test_split_mode_quarantines_and_dedupes(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    _write(spark, src, MSGS)
    out, bad, chk = (os.path.join(tmp_dir, x) for x in ("out", "bad", "chk"))
    qs = ingest.ingest_json_topic(spark, ingest.stream_source(spark, "text", path=src), ingest.USER_EVENT_SCHEMA,
                                  ["event_ts"], out, chk, trigger="available_now", quarantine=bad,
                                  dedup_keys=["user_id", "event_ts"])
    ingest.run_to_completion(qs)
    good = spark.read.parquet(out)
    assert sorted(r.user_id for r in good.collect()) == ["7", "u1", "u2"]
    reasons = sorted((r.reason for r in spark.read.parquet(bad).collect()))
    assert reasons == ["bad_timestamp", "malformed"]


def test_parse_batch_form_matches_stream(spark):
    df = spark.createDataFrame([(m,) for m in MSGS[:3]], "value string")
    parsed = ingest.parse_json_events(df, ingest.USER_EVENT_SCHEMA, ["event_ts"])
    assert parsed.columns == ["event_ts", "user_id", "name", "country"]
    assert dict(parsed.dtypes)["event_ts"] == "timestamp"
    ntz = ingest.parse_json_events(df, ingest.USER_EVENT_SCHEMA, ["event_ts"], ts_type="timestamp_ntz")
    assert dict(ntz.dtypes)["event_ts"] == "timestamp_ntz"


def test_user_events_into_bronze_layout(spark, tmp_dir):
    from contrail.sources.layout import Layout, read_table
    src = os.path.join(tmp_dir, "topic")
    _write(spark, src, MSGS)
    layout = Layout(warehouse=os.path.join(tmp_dir, "lake"))
    qs = ingest.ingest_user_events(spark, layout, source=ingest.stream_source(spark, "text", path=src),
                                   trigger="available_now", quarantine=True, dedup=True)
    ingest.run_to_completion(qs)
    assert read_table(spark, layout, "bronze", "events_raw").count() == 3
    assert read_table(spark, layout, "bronze", "events_raw_quarantine").count() == 2


def test_late_distinct_messages_and_null_keys_are_all_kept(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    out, chk = (os.path.join(tmp_dir, x) for x in ("out", "chk"))
    late = '{"event_ts":"2023-12-01T00:00:00Z","user_id":"u8","name":"late","country":"FR"}'
    for lines in (MSGS, [late, MSGS[2], MSGS[3]], [late, MSGS[3]]):  # the second batch is a month older than the first
        _write(spark, src, lines)
        ingest.run_to_completion(ingest.ingest_json_topic(
            spark, ingest.stream_source(spark, "text", path=src, per_trigger=1), ingest.USER_EVENT_SCHEMA, ["event_ts"], out, chk,
            trigger="available_now", dedup_keys=["user_id", "event_ts"]))
    rows = spark.read.parquet(out).collect()
    assert sorted(r.user_id for r in rows if r.event_ts is not None) == ["7", "u1", "u2", "u8"]
    assert sum(r.user_id is None for r in rows) == 3 and sum(r.user_id == "u4" for r in rows) == 1


def _msg(ts, user, name="n"):
    return f'{{"event_ts":"{ts}","user_id":"{user}","name":"{name}","country":"FR"}}'


def _distinct(spark, src, out, chk, **kw):
    qs = ingest.ingest_json_topic(spark, ingest.stream_source(spark, "text", path=src, per_trigger=1), ingest.USER_EVENT_SCHEMA, ["event_ts"],
                                  out, chk, trigger="available_now", dedup_keys=["user_id", "event_ts"], **kw)
    ingest.run_to_completion(qs)


def test_state_recognises_repeats_and_only_late_rows_read_the_target(spark, tmp_dir, monkeypatch):
    """Four batches over 30 days, a restart after the second: the target is read for the days of late rows alone."""
    src, out, chk = (os.path.join(tmp_dir, x) for x in ("in", "out", "chk"))
    looked = []
    plain = ingest.held_keys
    monkeypatch.setattr(ingest, "held_keys", lambda s, t, days, schema, but: looked.append((but, sorted(days))) or plain(s, t, days, schema, but))
    days = [f"2024-01-{d:02d}T12:00:00Z" for d in range(1, 31)]
    first = [_msg(t, f"u{i}") for i, t in enumerate(days[:10])]
    second = [_msg(t, f"u{i}") for i, t in enumerate(days[8:20], 8)] + first[8:]  # repeats of the last two days
    third = [_msg(t, f"u{i}") for i, t in enumerate(days[20:], 20)] + first[:1] + [_msg(days[2], "late")] * 2
    fourth = [_msg(days[29], "u29"), _msg(days[29], "new"), _msg(days[2], "late")]
    for lines in (first, second):
        _write(spark, src, lines)
        _distinct(spark, src, out, chk)
    for lines in (third, fourth):  # both wait when the query starts again
        _write(spark, src, lines)
    _distinct(spark, src, out, chk)
    rows = spark.read.parquet(out).collect()
    assert sorted((str(r.event_ts), r.user_id) for r in rows) == sorted({(t[:10] + " 12:00:00", f"u{i}") for i, t in enumerate(days)}
                                                                       | {("2024-01-03 12:00:00", "late"), ("2024-01-30 12:00:00", "new")})
    assert {tuple(d) for b, d in looked if b == 3} <= {("2024-01-03",)}  # on-time repeats of the fourth batch were known to the state


def test_messages_that_share_user_and_second_are_both_kept(spark, tmp_dir):
    from contrail.sources.layout import Layout, read_table
    src = os.path.join(tmp_dir, "topic")
    a, b = _msg("2024-01-01T10:00:00Z", "u1", "a"), _msg("2024-01-01T10:00:00Z", "u1", "b")
    layout = Layout(warehouse=os.path.join(tmp_dir, "lake"))
    for lines in ([a, b, a], [b]):
        _write(spark, src, lines)
        ingest.run_to_completion(ingest.ingest_user_events(spark, layout, source=ingest.stream_source(spark, "text", path=src), trigger="available_now", dedup=True))
    got = read_table(spark, layout, "bronze", "events_raw")
    assert got.columns == ingest.USER_EVENT_SCHEMA.names and sorted(r.name for r in got.collect()) == ["a", "b"]


def test_a_key_without_the_event_time_is_refused(spark, tmp_dir):
    import pytest
    df = spark.createDataFrame([], ingest.USER_EVENT_SCHEMA)
    with pytest.raises(ValueError):
        ingest.ingest_distinct(df, f"{tmp_dir}/o", f"{tmp_dir}/c", ["user_id"], "event_ts")


def test_a_replayed_batch_replaces_itself(spark, tmp_dir):
    """The offsets of a batch are logged, its commit is not: the batch runs again after a restart."""
    import glob
    src, out, chk = (os.path.join(tmp_dir, x) for x in ("in", "out", "chk"))
    _write(spark, src, [_msg("2024-01-01T00:00:00Z", "u1"), '{"broken'])
    _distinct(spark, src, out, chk)
    last = max(glob.glob(f"{chk}/commits/[0-9]*"), key=lambda f: int(os.path.basename(f)))
    os.rename(last, os.path.join(tmp_dir, "commit-taken-away"))
    for crc in glob.glob(f"{chk}/commits/.{os.path.basename(last)}.crc"):
        os.rename(crc, os.path.join(tmp_dir, "crc-taken-away"))
    _distinct(spark, src, out, chk)
    assert sorted(str(r.user_id) for r in spark.read.parquet(out).collect()) == ["None", "u1"]


def test_long_running_query_stops_between_batches_and_goes_on(spark, tmp_dir):
    import time
    src, out, chk = (os.path.join(tmp_dir, x) for x in ("in", "out", "chk"))

    def start():
        return ingest.ingest_json_topic(spark, ingest.stream_source(spark, "text", path=src, per_trigger=1), ingest.USER_EVENT_SCHEMA, ["event_ts"],
                                        out, chk, trigger="0 seconds")[0]

    def wait(q, rows):
        until = time.monotonic() + 120
        while sum(n for _, n, _ in ingest.progress_rows(q)) < rows and time.monotonic() < until:
            time.sleep(0.1)

    _write(spark, src, MSGS[:2])
    _write(spark, src, MSGS[2:4])
    q = start()
    wait(q, 2)
    ingest.stop_cleanly(q)
    done = spark.read.parquet(out).count()
    assert not q.isActive and done in (2, 4) and all(ms > 0 for _, _, ms in ingest.progress_rows(q))
    _write(spark, src, MSGS[4:])
    q = start()
    wait(q, len(MSGS) - done)
    ingest.stop_cleanly(q)
    assert spark.read.parquet(out).count() == len(MSGS)


def test_shared_folder_without_a_preset(tmp_dir):
    """In a process whose Spark configuration names no checkpoint folder."""
    import subprocess
    import sys
    code = ("from contrail.session import get_spark, shared_dir, materialize\n"
            "s = get_spark('local[1]')\n"
            "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
            "a, b = shared_dir(s), shared_dir(s)\n"
            "assert a == b, (a, b)\n"
            "assert materialize(s, s.range(3), 'x').count() == 3\n"
            "print('shared', a)\n")
    os.makedirs(os.path.join(tmp_dir, "conf"))
    env = {**os.environ, "SPARK_CONF_DIR": os.path.join(tmp_dir, "conf"), "PYSPARK_SUBMIT_ARGS": "pyspark-shell"}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = subprocess.run([sys.executable, "-c", code], env=env, cwd=root, capture_output=True, text=True, timeout=180)
    assert got.returncode == 0 and "shared" in got.stdout, got.stderr[-2000:]


def test_dropped_path_table_is_gone(spark, tmp_dir):
    import pytest
    from pyspark.errors import AnalysisException
    from contrail.sources.layout import Layout, drop_table, read_table, write_table
    layout = Layout(warehouse=tmp_dir)
    write_table(spark.range(3), layout, "silver", "gone")
    assert read_table(spark, layout, "silver", "gone").count() == 3
    drop_table(spark, layout, "silver", "gone")
    with pytest.raises(AnalysisException):
        read_table(spark, layout, "silver", "gone")
    drop_table(spark, layout, "silver", "gone")  # twice is no error
