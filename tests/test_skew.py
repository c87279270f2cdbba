"""Hot keys: one key holding a third of all rows must not change results,
and the skew-split path must actually engage when a join key is hot."""

from pyspark.sql import functions as F

from contrail.plans import gold, silver
from contrail.sources.fixtures import Airline

from .conftest import SF01


def _hot(df, col, hot):
    """Re-key a deterministic third of the rows to one hot value."""
    return df.withColumn(col, F.when(F.xxhash64(*df.columns) % 3 == 0, F.lit(hot)).otherwise(F.col(col)))


def test_boarding_summary_with_a_hot_flight_matches_brute_force(spark):
    ev = _hot(Airline(spark, SF01).boarding_events, "flight_id", "HOT")
    got = {r.flight_id: (r.passenger_count, float(r.total_baggage_weight))
           for r in silver.build_boarding_summary(ev, audit=False).collect()}
    pdf = ev.toPandas()
    scans = pdf[pdf.event_type == "passenger_scanned"]
    want = scans.groupby("flight_id").agg(n=("event_type", "count"), w=("baggage_weight", "sum"))
    assert len(got) == len(want)
    hot_n = int(want.loc["HOT", "n"])
    assert hot_n > len(scans) // 4  # the hot key really holds a large share
    for fid, row in want.iterrows():
        assert got[fid][0] == row.n and abs(got[fid][1] - float(row.w)) < 1e-6


def test_skew_join_split_engages_and_keeps_results(spark):
    a = Airline(spark, SF01)
    # a third of events on flight "4"; 8 map tasks, as a multi-file input would
    # have (AQE splits a skewed partition along map-output boundaries)
    events = _hot(a.flights_events, "flight_id", "4").repartition(8)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    reasons = silver.build_delay_reasons(events, a.flights, audit=False)
    baseline = sorted(tuple(r) for r in gold.build_monthly_delays(a.flights, events, reasons, audit=False).collect())
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = gold.build_monthly_delays(a.flights, events, reasons, audit=False)
        skewed = sorted(tuple(r) for r in df.collect())
        final_plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in final_plan

    def norm(rows):
        return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows]
    assert norm(skewed) == norm(baseline)
