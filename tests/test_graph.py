"""Concurrent layer runs: order, failures kept apart, reports."""

import threading

import pytest

from contrail.plans import graph, runs
from contrail.plans.graph import FAILED, SKIPPED, WRITTEN, Step
from contrail.sources.layout import Layout, read_table


def test_ready_steps_run_at_once_and_needs_come_first(spark):
    together = threading.Barrier(3, timeout=60)  # passes only if three steps run at the same time
    seen = []

    def dim(n):
        def run(tables):
            together.wait()
            seen.append(n)
            return spark.range(n)
        return run

    def fact(tables):
        assert set(tables) == {"a", "b", "c"}
        return tables["a"].union(tables["b"]).union(tables["c"])

    got = graph.run_graph(spark, [Step("f", fact, ("a", "b", "c")), Step("a", dim(1)), Step("b", dim(2)), Step("c", dim(3))], workers=3)
    assert sorted(seen) == [1, 2, 3] and got["f"].table.count() == 6 and list(got)[-1] == "f"
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None  # the caller's thread keeps its pool


def test_a_failure_holds_up_only_what_needs_it(spark):
    def bad(tables):
        raise ValueError("no such column")

    steps = [Step("a", lambda t: spark.range(4)), Step("b", bad), Step("c", lambda t: t["a"], ("a",)), Step("d", lambda t: t["b"], ("b",)),
             Step("e", lambda t: t["d"], ("d", "a"))]
    for workers in (1, 4):
        got = graph.run_graph(spark, steps, workers)
        assert {n: o.status for n, o in got.items()} == {"a": WRITTEN, "b": FAILED, "c": WRITTEN, "d": SKIPPED, "e": SKIPPED}
    rows = {r.table_name: r for r in graph.outcome_table(spark, got).collect()}
    assert rows["a"].rows_written == 4 and "no such column" in rows["b"].error and rows["e"].error == "needs d" and rows["d"].rows_written is None


@pytest.mark.parametrize("steps", [[Step("a", None), Step("a", None)], [Step("a", None, ("x",))], [Step("a", None, ("b",)), Step("b", None, ("a",))]])
def test_graphs_that_cannot_run_are_refused(spark, steps):
    with pytest.raises(ValueError):
        graph.run_graph(spark, steps)
    assert graph.run_graph(spark, []) == {}


def test_layer_run_reports_or_raises(spark, tmp_dir):
    from contrail.registry import silver_tables
    from contrail.sources.fixtures import Airline
    from .conftest import SF001
    t = silver_tables(Airline(spark, SF001))
    s = {n: t[n] for n in ("silver_routes", "silver_flights", "silver_flights_events", "silver_weather_summary", "silver_waypoint_sampling_weather_points")}
    s["silver_weather_summary"] = s["silver_weather_summary"].drop("average_temperature")
    layout = Layout(warehouse=tmp_dir)
    out = runs.run_gold_ml(spark, layout, s, on_failure="report")
    status = {r.table_name: r.status for r in out["_outcomes"].collect()}
    assert status == {"gold_dim_ml_routes": WRITTEN, "gold_dim_ml_weather": FAILED, "gold_dim_ml_boarding_data": WRITTEN, "gold_fact_ml_training": SKIPPED}
    assert read_table(spark, layout, "gold", "gold_dim_ml_routes").count() > 0
    unchecked = {r.table_name for r in out["_quality"].where("violations is null").collect()}  # rules of what is missing
    assert unchecked == {"gold_dim_ml_weather", "gold_fact_ml_training"}
    with pytest.raises(graph.LayerRunError) as e:
        runs.run_gold_ml(spark, layout, s)
    assert e.value.outcomes["gold_dim_ml_weather"].status == FAILED and "gold_fact_ml_training: skipped" in str(e.value)
