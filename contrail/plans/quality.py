"""One-pass data-quality engine.

Rules are data (``Rule``). ``run_checks`` turns a rule set into a single
DataFrame of results ``(table_name, rule, column_name, violations, passed,
severity)``:

- every row-level rule of one table (not-null, range, bound, enum, order,
  derived) becomes one ``count_if`` inside ONE aggregation per table — one
  scan instead of one Spark job per rule;
- all key uniqueness and foreign keys are ONE pass: every table is scanned
  once, keys are tagged by domain and role and grouped in one shuffle (no
  join: a hot or NULL key costs one partially-aggregated row per task);
  with ``one_pass`` the row-level rules of these tables ride on it;
- schema rules (required columns, types) read metadata only.

NULL semantics: a NULL never violates a row-level rule except ``not_null``;
NULL keys form one group for uniqueness; a NULL foreign key is an orphan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail import schema

ROW_KINDS = {"not_null", "range", "min", "max", "enum", "order", "derived"}
RESULT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("violations", T.LongType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("severity", T.StringType()),
])


@dataclass(frozen=True)
class Rule:
    table: str
    kind: str
    columns: tuple[str, ...]
    params: tuple = field(default=())
    severity: str = "error"

    @property
    def label(self) -> str:
        return ",".join(self.columns)


# ---------------------------------------------------------------- constructors
def not_null(table, *cols, severity="error"):
    return [Rule(table, "not_null", (c,), (), severity) for c in cols]


def in_range(table, col, lo, hi, severity="error"):
    return Rule(table, "range", (col,), (lo, hi), severity)


def at_least(table, col, lo, strict=False, severity="error"):
    """Violation when col < lo (or col <= lo when ``strict``)."""
    return Rule(table, "min", (col,), (lo, strict), severity)


def at_most(table, col, hi, severity="error"):
    return Rule(table, "max", (col,), (hi,), severity)


def one_of(table, col, values, severity="error"):
    return Rule(table, "enum", (col,), tuple(values), severity)


def ordered(table, first, second, strict=False, severity="error"):
    """Violation when first > second (or first >= second when ``strict``)."""
    return Rule(table, "order", (first, second), (strict,), severity)


def derived(table, target, num, den, tol=1e-3, severity="error"):
    """Violation when |num / den − target| > tol (a zero divisor never violates)."""
    return Rule(table, "derived", (target, num, den), (tol,), severity)


def unique(table, *cols, severity="error"):
    return Rule(table, "unique", tuple(cols), (), severity)


def foreign_key(table, col, parent, parent_col=None, severity="error"):
    return Rule(table, "fk", (col,), (parent, parent_col or col), severity)


def required(table, cols, severity="error"):
    return Rule(table, "required", tuple(cols), (), severity)


def types(table, expected: Mapping[str, str], severity="error"):
    return Rule(table, "types", tuple(expected), tuple(expected.values()), severity)


def consistent(table, keys, col, other, other_col, tol=1e-6, severity="error"):
    """Aggregate consistency: ``table.col`` equals ``other.other_col`` on ``keys``
    (full outer join; a key on one side only is a violation)."""
    return Rule(table, "consistent", (col,), (tuple(keys), other, other_col, tol), severity)


def cross_order(table, key, other, other_key, first, second, severity="error"):
    """Cross-table chronology: ``table.first`` must not be after ``other.second``
    for rows joined on ``table.key = other.other_key``."""
    return Rule(table, "cross_order", (first, second), (key, other, other_key), severity)


# ---------------------------------------------------------------- compilation
def violation(rule: Rule) -> Column:
    """Boolean Column that is true on a violating row (NULL = no violation)."""
    c = [F.col(x) for x in rule.columns]
    k, p = rule.kind, rule.params
    if k == "not_null":
        return c[0].isNull()
    if k == "range":
        return (c[0] < F.lit(p[0])) | (c[0] > F.lit(p[1]))
    if k == "min":
        return (c[0] <= F.lit(p[0])) if p[1] else (c[0] < F.lit(p[0]))
    if k == "max":
        return c[0] > F.lit(p[0])
    if k == "enum":
        return ~c[0].isin(list(p))
    if k == "order":
        return (c[0] >= c[1]) if p[0] else (c[0] > c[1])
    if k == "derived":
        ratio = F.try_divide(c[1].cast("double"), c[2].cast("double"))
        return F.abs(ratio - c[0].cast("double")) > F.lit(p[0])
    raise ValueError(f"not a row-level rule: {k}")


def _meta(rule: Rule, violations) -> tuple:
    return (rule.table, rule.kind, rule.label, violations, None if violations is None else violations == 0,
            rule.severity)


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _from_count(count_df: DataFrame, rule: Rule) -> DataFrame:
    # one selectExpr = one JVM round trip for the whole result projection
    return count_df.selectExpr(
        f"{_sql_str(rule.table)} AS table_name", f"{_sql_str(rule.kind)} AS rule",
        f"{_sql_str(rule.label)} AS column_name", "CAST(violations AS BIGINT) AS violations",
        "CAST(violations AS BIGINT) = 0 AS passed", f"{_sql_str(rule.severity)} AS severity")


def _row_level(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """All row-level rules of one table as ONE aggregation, unpivoted to one
    row per rule with ``stack`` (a single projection, no extra scan)."""
    counts = df.agg(*[F.count_if(violation(r)).alias(f"_r{i}") for i, r in enumerate(rules)])
    args = ", ".join(f"{_sql_str(r.kind)}, {_sql_str(r.label)}, CAST(_r{i} AS BIGINT), {_sql_str(r.severity)}"
                     for i, r in enumerate(rules))
    out = counts.selectExpr(f"stack({len(rules)}, {args}) AS (rule, column_name, violations, severity)")
    return out.selectExpr(f"{_sql_str(table)} AS table_name", "rule", "column_name", "violations",
                          "violations = 0 AS passed", "severity")


def _domains(rules: Sequence[Rule]) -> dict[tuple[str, tuple[str, ...]], tuple[int, int]]:
    """(domain, role) of every key that uniqueness and foreign-key rules name, a key being (table, columns).

    A foreign key and the key that it refers to are of one domain; roles number the keys of a domain.
    """
    up: dict = {}

    def root(k):
        while up.setdefault(k, k) != k:
            k = up[k]
        return k

    for r in rules:
        key = root((r.table, r.columns))
        if r.kind == "fk":
            up[root((r.params[0], (r.params[1],)))] = key
    numbers: dict = {}
    out, sizes = {}, {}
    for k in list(up):
        d = numbers.setdefault(root(k), len(numbers))
        out[k] = (d, sizes.get(d, 0))
        sizes[d] = sizes.get(d, 0) + 1
    return out


def _key(df: DataFrame, columns: Sequence[str], kind: str) -> Column:
    """A key as a string: NULL only for a single NULL column; each column of a compound key is told apart by its length."""
    if len(columns) == 1:
        return F.col(columns[0]).cast(kind).cast("string")
    text = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


#: Row-level rules whose outcomes one number holds, a bit each.
RULES_PER_MASK = 62


def _key_pass(spark: SparkSession, tables: Mapping[str, DataFrame], rules: Sequence[Rule],
              riders: Sequence[Rule] = ()) -> DataFrame:
    """All uniqueness and foreign-key rules in ONE shuffle.

    Every table is scanned once and gives a row (domain, key, role) for each of its keys; grouped by domain
    and key, the counts of the roles tell duplicates (a role with more than one row) and orphans (a key that
    the parent's role lacks) together. Partial aggregation turns a hot or NULL key into one row per task, and
    there is no join. NULL keys are one group for uniqueness; a NULL foreign key is an orphan.
    ``riders`` are row-level rules of the same tables, which need no scan of their own: a row that breaks some
    gives one more row, whose key is the set of these rules, in a domain of the table. Keys and rows without
    fault are left out before the rules are summed.
    """
    place = _domains(rules)
    types_of = {k: dict(tables[k[0]].dtypes)[k[1][0]] for k in place if len(k[1]) == 1}
    kinds: dict[int, str] = {}  # keys of unlike types are compared as the first that is not text
    for k, (d, _) in place.items():
        kind = types_of.get(k, "string")
        if kinds.setdefault(d, kind) == "string":
            kinds[d] = kind
    by_table: dict[str, list] = {}
    for (table, columns), (d, role) in place.items():
        by_table.setdefault(table, []).append((columns, d, role))
    clean = 1 + max(d for d, _ in place.values())  # domains from here on are sets of broken rules
    masks: dict[str, list[tuple[int, list[Rule]]]] = {}
    bit: dict[int, tuple[int, int]] = {}
    free = clean
    for table in by_table:
        mine = [i for i, r in enumerate(riders) if r.table == table]
        for at in range(0, len(mine), RULES_PER_MASK):
            some = mine[at:at + RULES_PER_MASK]
            bit.update({i: (free, 1 << b) for b, i in enumerate(some)})
            masks.setdefault(table, []).append((free, [riders[i] for i in some]))
            free += 1
    parts = []
    for table, keys in by_table.items():
        df = tables[table]
        rows = [F.struct(F.lit(d).alias("domain"), F.lit(role).alias("role"), _key(df, columns, kinds[d]).alias("key")) for columns, d, role in keys]
        for d, held in masks.get(table, ()):
            broken = reduce(Column.__add__, [F.when(violation(r), F.lit(1 << b)).otherwise(F.lit(0)).cast("long") for b, r in enumerate(held)])
            rows.append(F.struct(F.lit(d).alias("domain"), F.lit(0).alias("role"), F.nullif(broken, F.lit(0)).cast("string").alias("key")))
        # one key: no row generator
        part = df.select(F.inline(F.array(*rows))) if len(rows) > 1 else df.select(rows[0].alias("r")).select("r.*")
        parts.append(part.where((F.col("domain") < clean) | F.col("key").isNotNull()) if table in masks else part)
    roles = 1 + max(role for _, role in place.values())
    counts = reduce(DataFrame.unionByName, parts).groupBy("domain", "key").agg(
        *[F.count_if(F.col("role") == r).alias(f"n{r}") for r in range(roles)])

    def case(r: Rule) -> tuple[int, ...]:
        """The role whose rows a rule looks at, for a foreign key also the parent's: alike in all domains."""
        role = place[r.table, r.columns][1]
        return (role,) if r.kind == "unique" else (role, place[r.params[0], (r.params[1],)][1])

    faults = {c: (F.col(f"n{c[0]}") > 1) if len(c) == 1 else
              (F.col(f"n{c[0]}") > 0) & (F.col("key").isNull() | (F.col(f"n{c[1]}") == 0)) for c in sorted(set(map(case, rules)))}
    name = {c: "_".join(["f", *map(str, c)]) for c in faults}
    faulty = counts.where(reduce(Column.__or__, faults.values(), F.col("domain") >= clean)).select(
        "domain", F.when(F.col("domain") >= clean, F.col("key").cast("long")).alias("broken"), F.col("n0").alias("n"),
        *[F.when(bad, F.lit(1) if len(c) == 1 else F.col(f"n{c[0]}")).alias(name[c]) for c, bad in faults.items()])
    if riders:  # their many sums meet a row per domain and set
        faulty = faulty.groupBy("domain", "broken").agg(*[F.sum(c).alias(c) for c in ("n", *name.values())])

    def found(r: Rule) -> Column:
        d, _ = place[r.table, r.columns]
        return F.coalesce(F.sum(F.when(F.col("domain") == d, F.col(name[case(r)]))), F.lit(0))

    def ridden(i: int) -> Column:
        d, b = bit[i]
        here = (F.col("domain") == d) & (F.col("broken").bitwiseAND(F.lit(b)) != 0)
        return F.coalesce(F.sum(F.when(here, F.col("n"))), F.lit(0))

    total = faulty.agg(*[c.alias(f"_r{i}") for i, c in enumerate([*map(found, rules), *map(ridden, range(len(riders)))])])
    rules = [*rules, *riders]
    args = ", ".join(f"{_sql_str(r.table)}, {_sql_str(r.kind)}, {_sql_str(r.label)}, CAST(_r{i} AS BIGINT), {_sql_str(r.severity)}"
                     for i, r in enumerate(rules))
    out = total.selectExpr(f"stack({len(rules)}, {args}) AS (table_name, rule, column_name, violations, severity)")
    return out.selectExpr("table_name", "rule", "column_name", "violations", "violations = 0 AS passed", "severity")


def _type_name(dt: T.DataType) -> str:
    return dt.simpleString()


def _scans(rule: Rule) -> list[str]:
    """Tables a rule reads with a Spark job (metadata rules read none)."""
    if rule.kind in ("required", "types"):
        return []
    if rule.kind in ("fk", "consistent", "cross_order"):
        other = rule.params[0] if rule.kind == "fk" else rule.params[1]
        return [rule.table, other]
    return [rule.table]


def table_uses(rules: Sequence[Rule], one_pass: bool = False) -> dict[str, int]:
    """How often ``run_checks`` scans each table: once for its row-level rules, once for all its keys, once per other rule.

    With ``one_pass`` the row-level rules of a table that has keys to check take no scan of their own."""
    passes = set()
    for i, r in enumerate(rules):
        kind = "row" if r.kind in ROW_KINDS else "key" if r.kind in ("unique", "fk") else i
        passes |= {(t, kind) for t in _scans(r)}
    if one_pass:
        passes -= {(t, "row") for t, kind in passes if kind == "key"}
    uses: dict[str, int] = {}
    for t, _ in passes:
        uses[t] = uses.get(t, 0) + 1
    return uses


def run_checks(spark: SparkSession, tables: Mapping[str, DataFrame], rules: Sequence[Rule],
               stage=None, one_pass: bool = False) -> DataFrame:
    """Evaluate ``rules`` against ``tables``; one result row per rule.

    A rule on a table that is absent, or on columns the table lacks, yields
    ``violations = NULL, passed = NULL`` (the ``required`` rule reports why).
    ``stage(name, df) -> df`` is applied to every table that more than one
    Spark job will read (e.g. ``session.materialize``), so an expensive
    table plan is computed once rather than once per rule group. With
    ``one_pass`` the row-level rules of tables with keys to check are counted
    by the pass over the keys, so a table that no other rule reads is computed
    once without being stored; stored tables are scanned faster apart.
    """
    uses = table_uses(rules, one_pass)
    staged: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame | None:
        if name not in staged:
            df = tables.get(name)
            if df is not None and stage is not None and uses.get(name, 0) > 1:
                df = stage(name, df)
            staged[name] = df
        return staged[name]

    parts: list[DataFrame] = []
    meta: list[tuple] = []
    row_rules: dict[str, list[Rule]] = {}
    key_rules: list[Rule] = []
    for r in rules:
        df = tables.get(r.table) if r.kind in ("required", "types") else table(r.table)
        cols = set(df.columns) if df is not None else set()
        if r.kind == "required":
            missing = [c for c in r.columns if c not in cols] if df is not None else list(r.columns)
            meta.append(_meta(r, len(missing)))
            continue
        if r.kind == "types":
            if df is None:
                meta.append(_meta(r, None))
                continue
            actual = {f.name: _type_name(f.dataType) for f in df.schema.fields}
            meta.append(_meta(r, sum(1 for c, t in zip(r.columns, r.params) if actual.get(c) != t)))
            continue
        if r.kind == "consistent":
            needed = set(r.columns) | set(r.params[0])
        elif r.kind == "cross_order":
            needed = {r.columns[0], r.params[0]}
        else:
            needed = set(r.columns)
        if df is None or not needed <= cols:
            meta.append(_meta(r, None))
            continue
        if r.kind in ROW_KINDS:
            row_rules.setdefault(r.table, []).append(r)
        elif r.kind == "unique":
            key_rules.append(r)
        elif r.kind == "fk":
            parent = table(r.params[0])
            if parent is None or r.params[1] not in parent.columns:
                meta.append(_meta(r, None))
                continue
            key_rules.append(r)
        elif r.kind == "consistent":
            keys, other, other_col, tol = r.params
            o = table(other)
            if o is None:
                meta.append(_meta(r, None))
                continue
            a = df.select(*keys, F.col(r.columns[0]).cast("double").alias("_a"))
            b = o.select(*keys, F.col(other_col).cast("double").alias("_b"))
            j = a.join(b, list(keys), "full_outer")
            bad = j.where(F.col("_a").isNull() | F.col("_b").isNull() | (F.abs(F.col("_a") - F.col("_b")) > tol))
            parts.append(_from_count(bad.agg(F.count(F.lit(1)).alias("violations")), r))
        elif r.kind == "cross_order":
            key, other, other_key = r.params
            o = table(other)
            if o is None:
                meta.append(_meta(r, None))
                continue
            first, second = r.columns
            # counted per key and value first: a hot key joins as its few distinct values
            a = (df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k"), F.col(first).alias("_a"))
                 .agg(F.count(F.lit(1)).alias("_m")))
            b = (o.where(F.col(other_key).isNotNull()).groupBy(F.col(other_key).alias("_k"), F.col(second).alias("_b"))
                 .agg(F.count(F.lit(1)).alias("_n")))
            bad = a.join(b, "_k").where(F.col("_a") > F.col("_b"))
            parts.append(_from_count(bad.agg(F.coalesce(F.sum(F.col("_m") * F.col("_n")), F.lit(0)).alias("violations")), r))
        else:
            raise ValueError(f"unknown rule kind {r.kind!r}")
    named = {t for r in key_rules for t in _scans(r)}
    riding = named & set(row_rules) if one_pass else set()
    for name, rs in row_rules.items():
        if name not in riding:
            parts.append(_row_level(table(name), name, rs))
    if key_rules:
        riders = [r for name, rs in row_rules.items() if name in riding for r in rs]
        parts.append(_key_pass(spark, {t: table(t) for t in named}, key_rules, riders))
    if meta or not parts:
        parts.append(spark.createDataFrame(meta, RESULT_SCHEMA))
    # every part has the result columns in the same order: positional union
    return reduce(lambda x, y: x.union(y), parts)


def observe_row_rules(df: DataFrame, table: str, rules: Sequence[Rule]):
    """Attach a table's row-level rules to ``df`` as ``observe`` metrics.

    The counts are computed by whatever action runs next (typically the
    write), so validating a freshly written table needs no extra scan for
    these rules. Returns ``(observed_df, observation, rules_observed)``;
    read the results with ``observed_results`` after the action.
    """
    from pyspark.sql import Observation

    cols = set(df.columns)
    rs = [r for r in rules if r.table == table and r.kind in ROW_KINDS and set(r.columns) <= cols]
    if not rs:
        return df, None, []
    obs = Observation(f"dq_{table}")
    return df.observe(obs, *[F.count_if(violation(r)).alias(f"_r{i}") for i, r in enumerate(rs)]), obs, rs


def observed_results(spark: SparkSession, observation, rules: Sequence[Rule]) -> DataFrame:
    """Result rows for rules observed during an action (one row per rule)."""
    metrics = observation.get if observation is not None else {}
    return spark.createDataFrame([_meta(r, int(metrics[f"_r{i}"])) for i, r in enumerate(rules)], RESULT_SCHEMA)


class DataQualityError(Exception):
    def __init__(self, failures: list):
        self.failures = failures
        lines = [f"{f['table_name']}: {f['rule']} {f['column_name']} -> {f['violations']}" for f in failures]
        super().__init__("data quality checks failed:\n" + "\n".join(lines))


def abort_if_errors(results: DataFrame) -> None:
    """Raise with the full failure list after every check has run.

    The result has one row per rule (bounded by the rule set), so bringing it
    to the driver is safe.
    """
    bad = (results.where((F.col("severity") == "error") & ~F.coalesce(F.col("passed"), F.lit(False)))
           .orderBy("table_name", "rule", "column_name").collect())
    if bad:
        raise DataQualityError([r.asDict() for r in bad])


# ---------------------------------------------------------------- rule sets
def _nn_all(table):
    return not_null(table, *schema.REQUIRED[table])


def bronze_rules(schemas: Mapping[str, T.StructType], legacy: bool = False) -> list[Rule]:
    """Q12: bronze tables have their columns and declared types; ids (the first
    column) and times are not NULL; coordinates and prices lie in their ranges.
    ``legacy`` adds the three tables the old bronze validator expected
    (airports, aircrafts, flights)."""
    R: list[Rule] = []
    for t, sch in schemas.items():
        R.append(required(t, [f.name for f in sch.fields]))
        R.append(types(t, {f.name: _type_name(f.dataType) for f in sch.fields}))
        R += not_null(t, *dict.fromkeys([sch.fields[0].name, *(f.name for f in sch.fields
                                                               if isinstance(f.dataType, T.TimestampType))]))
        for f in sch.fields:
            if f.name.startswith("latitude"):
                R.append(in_range(t, f.name, -90, 90))
            elif f.name.startswith("longitude"):
                R.append(in_range(t, f.name, -180, 180))
            elif f.name in ("price", "ticket_price", "luggage_fee"):
                R.append(at_least(t, f.name, 0))
    if legacy:
        R += [required(t, cols) for t, cols in schema.LEGACY_BRONZE.items()]
    return R


def silver_rules() -> list[Rule]:
    """The silver validator's rule set, canonical names, plus the checks it
    documents but never wrote (destination coordinates, waypoint keys, …)."""
    R: list[Rule] = [required(t, cols) for t, cols in schema.REQUIRED.items() if t.startswith("silver_")]
    R += [types(t, cols) for t, cols in TYPES.items() if t.startswith("silver_")]
    t = "silver_routes"
    R += _nn_all(t) + [in_range(t, "latitude_origin", -90, 90), in_range(t, "longitude_origin", -180, 180),
                       in_range(t, "latitude_destination", -90, 90), in_range(t, "longitude_destination", -180, 180),
                       at_least(t, "distance_km", 0, strict=True), unique(t, "routes_id")]
    t = "silver_flights"
    R += not_null(t, "flight_id", "routes_id", "scheduled_departure", "scheduled_arrival") + [
        unique(t, "flight_id"), foreign_key(t, "routes_id", "silver_routes"),
        at_least(t, "possible_passenger_amount", 0), at_least(t, "possible_luggage_weight", 0),
        ordered(t, "scheduled_departure", "scheduled_arrival", strict=True)]
    t = "silver_waypoint_sampling_weather_points"
    R += _nn_all(t) + [in_range(t, "point_latitude", -90, 90), in_range(t, "point_longitude", -180, 180),
                       unique(t, "route_id", "way_point_number"),
                       foreign_key(t, "route_id", "silver_routes", "routes_id")]
    t = "silver_ticket_prices"
    R += not_null(t, "price_id", "silver_flight_id", "ticket_class", "ticket_price") + [
        unique(t, "price_id"), one_of(t, "ticket_class", schema.TICKET_CLASSES),
        at_least(t, "ticket_price", 0), at_least(t, "luggage_fee", 0), ordered(t, "start_date", "end_date"),
        foreign_key(t, "silver_flight_id", "silver_flights", "flight_id")]
    t = "silver_customers"
    R += not_null(t, "customer_passport_id", "customer_email") + [unique(t, "customer_passport_id")]
    t = "silver_flights_events"
    R += _nn_all(t) + [
        unique(t, "flight_event_id"), foreign_key(t, "flight_id", "silver_flights"),
        one_of(t, "delay_reason", schema.DELAY_REASONS)]
    t = "silver_boarding_summary"
    R += _nn_all(t) + [unique(t, "flight_id"), foreign_key(t, "flight_id", "silver_flights"),
                       derived(t, "avg_baggage_weight", "total_baggage_weight", "baggage_count"),
                       derived(t, "avg_baggage_per_passenger", "total_baggage_weight", "passenger_count")]
    t = "silver_agg_frequent_delay_reasons"
    R += _nn_all(t) + [unique(t, "delay_id"),
                       foreign_key(t, "silver_flight_event", "silver_flights_events", "flight_event_id"),
                       one_of(t, "delay_reason", schema.DELAY_REASONS)]
    t = "silver_flight_weather"
    R += not_null(t, "weather_sample_id", "silver_flight_id", "weather_condition") + [
        in_range(t, "temperature", -100, 60), in_range(t, "humidity", 0, 100), at_least(t, "wind_speed", 0),
        in_range(t, "wind_direction", 0, 360), unique(t, "weather_sample_id"),
        one_of(t, "weather_condition", schema.WEATHER_CONDITIONS)]
    t = "silver_weather_summary"
    R += not_null(t, "flight_id", "majority_weather_condition") + [
        in_range(t, "average_humidity", 0, 100), unique(t, "flight_id"),
        one_of(t, "majority_weather_condition", schema.WEATHER_CONDITIONS)]
    t = "silver_agg_cancelation_rate"
    R += not_null(t, "total_booking", "total_cancelation", "cancelation_rate") + [
        ordered(t, "total_cancelation", "total_booking"), in_range(t, "cancelation_rate", 0, 1),
        unique(t, "year", "month")]
    t = "silver_ticket_events"
    R += _nn_all(t) + [unique(t, "event_id"), one_of(t, "event_type", schema.TICKET_EVENT_TYPES),
                       foreign_key(t, "booked_ticket_id", "silver_booked_tickets")]
    t = "silver_booked_tickets"
    R += not_null(t, "booked_ticket_id", "ticket_class", "customer_passport_id") + [
        unique(t, "booked_ticket_id"), one_of(t, "ticket_class", schema.TICKET_CLASSES),
        foreign_key(t, "customer_passport_id", "silver_customers")]
    return R


def gold_rules() -> list[Rule]:
    """The gold validator's rule set plus key, completeness and min ≤ avg checks.

    Negative delays are real (early departures), so the reference's
    non-negative delay rules are kept as warnings.
    """
    R: list[Rule] = [required(t, cols) for t, cols in schema.REQUIRED.items() if t.startswith("gold_")]
    R += [types(t, cols) for t, cols in TYPES.items() if t.startswith("gold_")]
    for t in schema.REQUIRED:
        if t.startswith("gold_"):
            R += _nn_all(t)
    for t, k in [("gold_dim_monthly_delays", "delays_id"), ("gold_dim_monthly_flight_info", "flights_info_id"),
                 ("gold_dim_monthly_revenue", "revenue_id"), ("gold_dim_monthly_most_popular", "metrics_id"),
                 ("gold_fact_monthly_performance_report", "report_id"), ("gold_monthly_aggregates", "aggregate_id")]:
        R += [unique(t, k), unique(t, "year", "month")]
    R += [unique("gold_dim_ml_routes", "route_id"), unique("gold_dim_ml_weather", "weather_id"),
          unique("gold_dim_ml_boarding_data", "boarding_data_id"), unique("gold_fact_ml_training", "training_set_id")]
    t = "gold_dim_monthly_delays"
    R += [at_least(t, "average_delay", 0, severity="warn"), ordered(t, "average_delay", "maximal_delay"),
          ordered(t, "minimal_delay", "average_delay")]
    t = "gold_dim_monthly_flight_info"
    R += [at_least(t, "total_passengers_number", 0), at_least(t, "average_passengers_number_on_flight", 0)]
    t = "gold_dim_monthly_revenue"
    R += [at_least(t, "total_revenue", 0), at_least(t, "revenue_per_passenger", 0),
          in_range(t, "cancelation_rate", 0, 1)]
    t = "gold_fact_ml_training"
    R += [at_least(t, "delay_in_minutes", 0, severity="warn")] + completeness_rules()[4:]
    t = "gold_dim_ml_routes"
    R += [at_least(t, "time_of_flight", 0), at_least(t, "distance_km", 0, strict=True)]
    t = "gold_dim_ml_weather"
    R += [at_least(t, "average_temperature", -100), at_least(t, "average_humidity", 0)]
    R += completeness_rules()[:4]
    return R


def completeness_rules() -> list[Rule]:
    """Q15: every fact id resolves to its dimension row."""
    f, m = "gold_fact_monthly_performance_report", "gold_fact_ml_training"
    return [foreign_key(f, "revenue_id", "gold_dim_monthly_revenue"),
            foreign_key(f, "flights_info_id", "gold_dim_monthly_flight_info"),
            foreign_key(f, "metrics_id", "gold_dim_monthly_most_popular"),
            foreign_key(f, "delays_id", "gold_dim_monthly_delays"),
            foreign_key(m, "route_id", "gold_dim_ml_routes"),
            foreign_key(m, "weather_id", "gold_dim_ml_weather"),
            foreign_key(m, "boarding_data_id", "gold_dim_ml_boarding_data")]


# Declared types (Q12, conformance): what the specs cast to, and what the builders make. Times keep their source type.
TYPES = {**{t: {name: dtype for _, name, dtype in spec if dtype is not None} for t, spec in schema.SILVER.items()},
         **schema.BUILT_TYPES}


def date_logic_rules() -> list[Rule]:
    """Q17: chronology within rows and between tables. A flight may leave early,
    so an event before its flight's date is a warning."""
    return [cross_order("silver_booked_tickets", "flight_id", "silver_flights", "flight_id",
                        "booking_date", "flight_date"),
            ordered("silver_ticket_prices", "start_date", "end_date"),
            ordered("silver_flights", "scheduled_departure", "scheduled_arrival", strict=True),
            cross_order("silver_booked_tickets", "booked_ticket_id", "silver_ticket_events", "booked_ticket_id",
                        "booking_date", "event_time"),
            cross_order("silver_flights", "flight_id", "silver_flights_events", "flight_id",
                        "flight_date", "event_time", severity="warn")]


def select_rules(rules: Sequence[Rule], *kinds: str) -> list[Rule]:
    return [r for r in rules if r.kind in kinds]
