"""Unit tier: hand-written frames per operator (ties, NULLs, zero divisors, empties)."""

import datetime as dt

from pyspark.sql import functions as F

from contrail.functions.columns import minutes_between, safe_ratio, surrogate_key
from contrail.operators import (align_periods, attach_scalar, conform, group_stats, latest_per_key, most_frequent,
                                orphans, top_n_per_group, with_period, with_surrogate_key)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else [tuple(r) for r in df.collect()]


def test_top_n_tie_break_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "c", 1), (2, "x", 2)], "g int, lab string, v int")
    out = top_n_per_group(df, ["g"], [F.col("v").desc(), F.col("lab").asc()], 1)
    assert rows(out, "g") == [(1, "a", 5), (2, "x", 2)]
    out2 = top_n_per_group(df, ["g"], [F.col("v").desc(), F.col("lab").asc()], 2, rank_col="r")
    assert rows(out2.select("g", "lab", "r"), "g", "r") == [(1, "a", 1), (1, "b", 2), (2, "x", 1)]


def test_top_n_requires_partition_keys(spark):
    import pytest
    with pytest.raises(ValueError):
        top_n_per_group(spark.range(3), [], [F.col("id")], 1)


def test_most_frequent_ties_alphabetical_and_nulls_ignored(spark):
    df = spark.createDataFrame([(1, "rain"), (1, "fog"), (1, None), (1, None), (1, None), (2, "clear")],
                               "m int, c string")
    out = most_frequent(df, ["m"], "c", "top", count_col="n")
    assert rows(out, "m") == [(1, "fog", 1), (2, "clear", 1)]


def test_most_frequent_weighted(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "a", 1)], "m int, c string, w long")
    assert rows(most_frequent(df, ["m"], "c", weight="w")) == [(1, "b")]


def test_latest_per_key_keeps_latest_ingestion(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([("f1", "A", t1), ("f1", "B", t2), ("f2", "C", t1), ("f2", "C", t1)],
                               "flight_id string, v string, ingestion_time timestamp")
    assert rows(latest_per_key(df, ["flight_id"]).select("flight_id", "v"), "flight_id") == [("f1", "B"), ("f2", "C")]


def test_safe_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0), (None, 2), (3.0, None), (6.0, 3)], "a double, b int")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [None, None, None, 2.0]


def test_minutes_between_signed(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 9, 40))], "a timestamp, b timestamp")
    assert df.select(minutes_between("a", "b")).first()[0] == -20.0


def test_surrogate_key_stable_and_matches_sha256(spark):
    import hashlib
    df = spark.createDataFrame([(2024, 1)], "year int, month int")
    got = df.select(surrogate_key("delays", "year", "month")).first()[0]
    assert got == hashlib.sha256(b"delays|2024|1").hexdigest()
    assert with_surrogate_key(df, "id", ["year", "month"], mode="uuid").first()["id"]


def test_with_period(spark):
    df = spark.createDataFrame([(dt.date(2023, 11, 5),)], "d date")
    assert tuple(with_period(df, "d").first()) == (dt.date(2023, 11, 5), 2023, 11)


def test_conform_aliases_cast_and_missing(spark):
    df = spark.createDataFrame([("r1", "3", "x")], "route_id string, max_passenger_capacity string, extra string")
    spec = [(["routes_id", "route_id"], "routes_id", "string"),
            (["possible_passenger_amount", "max_passenger_capacity"], "possible_passenger_amount", "int"),
            (["flight_date"], "flight_date", "date")]
    out = conform(df, spec, optional=["flight_date"])
    assert out.columns == ["routes_id", "possible_passenger_amount", "flight_date"]
    assert tuple(out.first()) == ("r1", 3, None)
    import pytest
    with pytest.raises(ValueError):
        conform(df, spec)
    assert conform(df, spec, missing="null").first().flight_date is None
    times = spark.createDataFrame([("2024-01-02 03:04:05",)], "t string")
    assert dict(conform(times, [(["t"], "t", None)]).dtypes)["t"] == "timestamp"


def test_a_missing_source_column_raises_and_the_load_time_stays(spark):
    import pytest
    from contrail.plans import silver
    df = spark.createDataFrame([("p1", "n", "a@b", "fr", "gold")], "a string, b string, c string, d string, e string")
    with pytest.raises(ValueError):
        silver.build_silver_customers(df)


def test_attach_scalar_picks_smallest_and_nulls_when_empty(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    dim = spark.createDataFrame([("b",), ("a",)], "wid string")
    assert rows(attach_scalar(df, dim, ["wid"]), "x") == [(1, "a"), (2, "a")]
    empty = spark.createDataFrame([], "wid string")
    assert rows(attach_scalar(df, empty, ["wid"]), "x") == [(1, None), (2, None)]


def test_orphans_counts_null_keys(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,), ("z",)], "k string")
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert sorted(rows(orphans(child, parent, "k")), key=str) == sorted([("z",), (None,)], key=str)


def test_align_periods_inner_drops_partial_months(spark):
    a = spark.createDataFrame([(2024, 1, 1), (2024, 2, 2)], "year int, month int, a int")
    b = spark.createDataFrame([(2024, 1, 9)], "year int, month int, b int")
    assert rows(align_periods([a, b])) == [(2024, 1, 1, 9)]
    assert len(align_periods([a, b], how="full").collect()) == 2


def test_group_stats_global_on_empty_gives_one_row(spark):
    df = spark.createDataFrame([], "x int")
    out = group_stats(df, [], {"mx": ("max", "x"), "n": ("count", "*")})
    assert rows(out) == [(None, 0)]
    g = spark.createDataFrame([(1, None), (1, 2)], "k int, v int")
    assert rows(group_stats(g, ["k"], {"n": ("count", "v"), "s": ("sum", "v")})) == [(1, 1, 2)]


def test_most_frequent_many_matches_separate_rankings(spark):
    from contrail.operators import most_frequent_many
    df = spark.createDataFrame([
        (1, "PAR", "TLV", "web"), (1, "AMS", "TLV", "web"), (1, "AMS", None, "app"),
        (2, "PAR", "BER", None), (3, None, None, None)], "m int, o string, d string, k string")
    out = most_frequent_many(df, ["m"], {"o": "top_o", "d": "top_d", "k": "top_k"})
    # month 2 has no order method and month 3 no label at all: both drop out
    assert rows(out, "m") == [(1, "AMS", "TLV", "web")]


def test_orphan_count_matches_orphans_with_nulls_and_hot_keys(spark):
    from contrail.operators import orphan_count
    child = spark.createDataFrame([("a",)] * 50 + [("z",)] * 7 + [(None,)] * 3, "k string")
    parent = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert orphan_count(child, parent, "k").first().violations == 10
    assert orphans(child, parent, "k").count() == 10
    ints = spark.createDataFrame([(1,), (2,)], "pk int")
    assert orphan_count(spark.createDataFrame([("1",), ("3",)], "k string"), ints, "k", "pk").first().violations == 1
