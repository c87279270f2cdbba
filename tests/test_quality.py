"""Fault injection: each rule with exactly k violations reports k."""

import datetime as dt

import pytest

from contrail.plans import quality as Q


def _viol(spark, tables, rule):
    r = Q.run_checks(spark, tables, [rule]).collect()
    assert len(r) == 1
    return r[0].violations


@pytest.mark.parametrize("k", [0, 1, 3])
def test_row_rules_report_exact_counts(spark, k):
    rows = [(float(i), 50.0, "first", 1, 2) for i in range(5)]
    rows += [(None, 500.0, "vip", 3, 3) for _ in range(k)]  # NULL lat, humidity 500, bad enum, a == b
    df = spark.createDataFrame(rows, "lat double, hum double, cls string, a int, b int")
    t = {"t": df}
    assert _viol(spark, t, Q.not_null("t", "lat")[0]) == k
    assert _viol(spark, t, Q.in_range("t", "hum", 0, 100)) == k
    assert _viol(spark, t, Q.at_most("t", "hum", 100)) == k
    assert _viol(spark, t, Q.one_of("t", "cls", ["first", "business", "economy"])) == k
    assert _viol(spark, t, Q.ordered("t", "a", "b", strict=True)) == k
    assert _viol(spark, t, Q.ordered("t", "a", "b")) == 0  # equal is fine when not strict
    # "first" repeats 5 times; "vip" repeats only when k >= 2
    assert _viol(spark, t, Q.unique("t", "cls")) == 1 + (1 if k >= 2 else 0)


def test_nulls_never_violate_value_rules(spark):
    df = spark.createDataFrame([(None, None, None)], "x double, c string, d date")
    t = {"t": df}
    assert _viol(spark, t, Q.in_range("t", "x", 0, 1)) == 0
    assert _viol(spark, t, Q.one_of("t", "c", ["a"])) == 0
    assert _viol(spark, t, Q.at_least("t", "x", 0, strict=True)) == 0


def test_unique_counts_duplicated_key_values_with_null_group(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,), ("c",)], "k string")
    assert _viol(spark, {"t": df}, Q.unique("t", "k")) == 2


def test_foreign_key_counts_null_as_orphan(spark):
    child = spark.createDataFrame([("r1",), ("r9",), (None,), ("r9",)], "routes_id string")
    parent = spark.createDataFrame([("r1",)], "routes_id string")
    assert _viol(spark, {"c": child, "p": parent}, Q.foreign_key("c", "routes_id", "p")) == 3


def test_derived_tolerance_and_zero_divisor(spark):
    df = spark.createDataFrame([(10.0, 2, 5.0), (10.0, 2, 5.0005), (10.0, 2, 5.1), (10.0, 0, 1.0)],
                               "total double, n long, avg double")
    assert _viol(spark, {"t": df}, Q.derived("t", "avg", "total", "n")) == 1


def test_chronology_equal_departure_arrival_violates(spark):
    t0 = dt.datetime(2024, 1, 1, 10)
    df = spark.createDataFrame([(t0, t0), (t0, t0 + dt.timedelta(hours=1))], "dep timestamp, arr timestamp")
    assert _viol(spark, {"t": df}, Q.ordered("t", "dep", "arr", strict=True)) == 1


def test_required_and_types_are_metadata_rules(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    assert _viol(spark, {"t": df}, Q.required("t", ["x", "y", "z", "w"])) == 2
    assert _viol(spark, {"t": df}, Q.types("t", {"x": "string", "y": "bigint"})) == 1
    r = Q.run_checks(spark, {"t": df}, Q.not_null("t", "nope")).first()
    assert r.violations is None and r.passed is None


def test_consistency_and_cross_order(spark):
    g = spark.createDataFrame([(2024, 1, 10.0), (2024, 2, 5.0)], "year int, month int, v double")
    d = spark.createDataFrame([(2024, 1, 10.0), (2024, 3, 1.0)], "year int, month int, v double")
    assert _viol(spark, {"g": g, "d": d}, Q.consistent("g", ("year", "month"), "v", "d", "v")) == 2
    b = spark.createDataFrame([("f1", dt.date(2024, 1, 5)), ("f2", dt.date(2024, 1, 1))], "fid string, bd date")
    f = spark.createDataFrame([("f1", dt.date(2024, 1, 4)), ("f2", dt.date(2024, 1, 1))], "fid string, fd date")
    assert _viol(spark, {"b": b, "f": f}, Q.cross_order("b", "fid", "f", "fid", "bd", "fd")) == 1


def test_abort_if_errors_lists_every_failure(spark):
    df = spark.createDataFrame([(None, -1.0)], "a string, b double")
    rules = Q.not_null("t", "a") + [Q.at_least("t", "b", 0), Q.at_least("t", "b", 0, severity="warn")]
    res = Q.run_checks(spark, {"t": df}, rules)
    with pytest.raises(Q.DataQualityError) as e:
        Q.abort_if_errors(res)
    assert len(e.value.failures) == 2
    Q.abort_if_errors(Q.run_checks(spark, {"t": df}, [Q.at_least("t", "b", 0, severity="warn")]))


def test_several_unique_rules_share_one_pass(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 2, 2), (None, 3, 3), (None, 3, 3)],
                               "k string, y int, m int")
    rules = [Q.unique("t", "k"), Q.unique("t", "y", "m"), Q.unique("t", "m")]
    got = {r.column_name: r.violations for r in Q.run_checks(spark, {"t": df}, rules).collect()}
    assert got == {"k": 2, "y,m": 1, "m": 2}


def test_observed_row_rules_count_during_the_action(spark, tmp_dir):
    import os
    df = spark.createDataFrame([(None, 5.0), ("a", -1.0), ("b", -2.0)], "k string, v double")
    rules = Q.not_null("t", "k") + [Q.at_least("t", "v", 0), Q.unique("t", "k")]
    observed, obs, rs = Q.observe_row_rules(df, "t", rules)
    assert [r.kind for r in rs] == ["not_null", "min"]  # key rules are not row-level
    observed.write.parquet(os.path.join(tmp_dir, "t"))  # the write computes the metrics
    got = {r.rule: r.violations for r in Q.observed_results(spark, obs, rs).collect()}
    assert got == {"not_null": 1, "min": 2}


def test_engine_and_sql_state_the_same_rules():
    """The SQL side's rules are written apart from the engine's: neither side has one that the other lacks."""
    from contrail.registry import DQ_SETS
    from oracle.rules import rule_sets
    stated = rule_sets()
    assert set(stated) == set(DQ_SETS)
    for name, (layer, factory) in DQ_SETS.items():
        assert stated[name][0] == layer
        engine = sorted((r.table, r.kind, r.label, r.severity) for r in factory())
        assert engine == sorted((r.table, r.kind, ",".join(r.columns), r.severity) for r in stated[name][1])


def test_load_time_is_required_of_validated_tables():
    from contrail import schema
    for rules in (Q.silver_rules(), Q.gold_rules()):
        named = {r.table for r in rules if r.kind == "required" and "ingestion_time" in r.columns}
        assert named == {r.table for r in rules if r.kind == "required"} - schema.NOT_VALIDATED


def test_cross_order_counts_pairs_and_skips_null_keys(spark):
    import datetime as dt
    a = spark.createDataFrame([("k", dt.date(2024, 1, 3))] * 2 + [(None, dt.date(2024, 1, 9))], "k string, d date")
    b = spark.createDataFrame([("k", dt.date(2024, 1, 1)), ("k", dt.date(2024, 1, 2)), ("k", dt.date(2024, 1, 5)),
                               (None, dt.date(2024, 1, 1))], "k string, e date")
    assert _viol(spark, {"a": a, "b": b}, Q.cross_order("a", "k", "b", "k", "d", "e")) == 4
    assert _viol(spark, {"a": a.limit(0), "b": b}, Q.cross_order("a", "k", "b", "k", "d", "e")) == 0


def test_key_rules_of_several_tables_share_one_shuffle(spark):
    """Duplicates, orphans and completeness of two domains, with NULL, hot and unlike-typed keys, from one exchange by key."""
    flights = spark.createDataFrame([("f1", "r1"), ("f2", "r1"), ("f2", "r9"), (None, "r2"), (None, None)], "flight_id string, route string")
    routes = spark.createDataFrame([(1, "r1"), (2, "r2"), (2, "r2"), (None, None)], "no int, route string")
    events = spark.createDataFrame([("f1",)] * 50 + [("f7",)] * 3 + [(None,)], "flight_id string")
    stops = spark.createDataFrame([("1", "a", "b"), ("01", "a", "b"), ("3", "a", None), ("3", "a", None), (None, "ab", "")], "no string, x string, y string")
    t = {"f": flights, "r": routes, "e": events, "s": stops}
    rules = [Q.unique("f", "flight_id"), Q.unique("r", "route"), Q.unique("r", "no"), Q.unique("s", "x", "y"), Q.foreign_key("f", "route", "r"),
             Q.foreign_key("e", "flight_id", "f"), Q.foreign_key("s", "no", "r"), Q.foreign_key("r", "route", "f"), Q.foreign_key("e", "flight_id", "f", "gone"),
             Q.foreign_key("e", "flight_id", "none")]
    res = Q.run_checks(spark, t, rules)
    got = {(r.table_name, r.rule, r.column_name): r.violations for r in res.collect() if r.violations is not None}
    assert got == {("f", "unique", "flight_id"): 2, ("r", "unique", "route"): 1, ("r", "unique", "no"): 1, ("s", "unique", "x,y"): 2,
                   ("f", "fk", "route"): 2, ("e", "fk", "flight_id"): 4, ("s", "fk", "no"): 3, ("r", "fk", "route"): 1}
    assert res.where("violations is null").count() == 2
    plan = Q.run_checks(spark, t, rules[:8])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "Join" not in plan


def test_tables_are_counted_by_passes():
    rules = Q.not_null("a", "x", "y") + [Q.unique("a", "x"), Q.unique("a", "y"), Q.foreign_key("b", "x", "a"), Q.consistent("a", ("k",), "v", "c", "v")]
    assert Q.table_uses(rules) == {"a": 3, "b": 1, "c": 1}


def test_row_rules_ride_on_the_pass_over_keys(spark):
    """One pass gives what separate passes give: NULL and hot keys, rows that break several rules, more rules than one number holds."""
    t = spark.createDataFrame([("a", 1.0, 5), ("a", None, -1), (None, 200.0, None), (None, -3.0, 2), ("z", 7.0, 70), ("z", 7.0, 70)],
                              "k string, v double, n int")
    hot = spark.range(3000).selectExpr("cast(null as string) k", "cast(id % 2 as double) v", "cast(id as int) n")
    u = spark.createDataFrame([("a",), ("b",)], "k string")
    empty = u.where("k = 'none'")
    rules = [Q.unique("t", "k"), Q.foreign_key("t", "k", "u"), Q.unique("u", "k"), Q.unique("e", "k"), *Q.not_null("e", "k"),
             *Q.not_null("t", "k", "v", "n"), *Q.not_null("u", "k"), Q.in_range("t", "v", 0, 100), Q.ordered("t", "v", "n"),
             *[Q.at_most("t", "n", i) for i in range(70)], *Q.not_null("alone", "k")]
    tables = {"t": t.unionByName(hot), "u": u, "e": empty, "alone": u}
    apart = sorted(Q.run_checks(spark, tables, rules).collect())
    together = Q.run_checks(spark, tables, rules, one_pass=True)
    assert sorted(together.collect()) == apart
    got = {(r.table_name, r.rule, r.column_name): r.violations for r in apart if r.rule != "max"}
    assert (got["t", "not_null", "k"], got["t", "not_null", "v"], got["t", "range", "v"], got["t", "fk", "k"]) == (3002, 1, 2, 3004)
    assert Q.table_uses(rules)["t"] == 2 and Q.table_uses(rules, one_pass=True) == {"t": 1, "u": 1, "e": 1, "alone": 1}


def test_the_silver_report_stores_no_table(spark, monkeypatch):
    """Every built table is read once, as it is built."""
    from contrail import registry
    from tests.conftest import SF001

    def stored(*args):
        raise AssertionError(f"stored {args[-1]}")

    monkeypatch.setattr(registry, "materialize", stored)
    registry.REGISTRY["dq_silver_report"](spark, SF001)
