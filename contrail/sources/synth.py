"""Schema-driven synthetic data, generated on the executors.

The reference builds rows in a driver-side Python loop; here every value is
a hash of (seed, column, row id), so generation is distributed, reproducible
and scales to any row count with ``spark.range`` partitions.

Value rules per type: string → uuid-formatted hex, int → 1..100,
double/float → 1.00..100.00, boolean, date → within the 365 days before
``anchor``, timestamp → within ``anchor``'s year, decimal → 1.00..100.00;
any other type → NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.schema import BRONZE_SCHEMAS
from contrail.sources.layout import Layout, drop_table, write_table


def _h(seed: int, name: str, id_col: Column) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(name), id_col)


def _value(dt: T.DataType, seed: int, name: str, rid: Column, anchor: Column) -> Column:
    h = _h(seed, name, rid)
    if isinstance(dt, T.StringType):
        x = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.lit(name), rid.cast("string")), 256)
        return F.concat_ws("-", F.substring(x, 1, 8), F.substring(x, 9, 4), F.substring(x, 13, 4),
                           F.substring(x, 17, 4), F.substring(x, 21, 12))
    if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType)):
        return (F.pmod(h, F.lit(100)) + 1).cast(dt)
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return (F.lit(1.0) + F.pmod(h, F.lit(9901)) / F.lit(100.0)).cast(dt)
    if isinstance(dt, T.DecimalType):
        return (F.lit(1.0) + F.pmod(h, F.lit(9901)) / F.lit(100.0)).cast(dt)
    if isinstance(dt, T.BooleanType):
        return F.pmod(h, F.lit(2)) == 1
    if isinstance(dt, T.DateType):
        return F.date_sub(anchor, F.pmod(h, F.lit(365)).cast("int"))
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        start = F.trunc(anchor, "year").cast("timestamp")
        secs = F.pmod(h, F.lit(365 * 86400)).cast("long")
        return F.timestamp_seconds(F.unix_timestamp(start) + secs).cast(dt)
    return F.lit(None).cast(dt)


def synth_columns(rows: DataFrame, schema: T.StructType, seed: int = 0, id_col: str = "id",
                  anchor: str | None = None) -> DataFrame:
    """One synthetic row per input row, keyed by ``id_col`` (any column that
    identifies the row). ``anchor`` (yyyy-MM-dd) fixes the date range; default
    today. Nullability from the schema is kept as declared."""
    a = F.lit(anchor).cast("date") if anchor else F.current_date()
    rid = F.col(id_col)
    return rows.select(*[_value(f.dataType, seed, f.name, rid, a).alias(f.name) for f in schema.fields])


def synth_table(spark: SparkSession, schema: T.StructType, n: int = 10, seed: int = 0,
                anchor: str | None = None, partitions: int | None = None) -> DataFrame:
    """``n`` synthetic rows for ``schema`` (default 10, as the reference)."""
    ids = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(n)
    return synth_columns(ids, schema, seed, "id", anchor)


def seed_layer(spark: SparkSession, layout: Layout, tables: Mapping[str, T.StructType] | None = None,
               n: int = 10, seed: int = 0, layer: str = "bronze", on_error: str = "collect") -> list[dict]:
    """Drop and recreate each table with synthetic rows (B5 + A6 + B2/B3).

    Failures are isolated per table: with ``on_error="collect"`` the run
    continues and the status list reports them; ``"raise"`` stops at the first.
    """
    results = []
    for i, (name, sch) in enumerate((tables or BRONZE_SCHEMAS).items()):
        try:
            if layout.catalog:
                drop_table(spark, layout, layer, name)
            write_table(synth_table(spark, sch, n, seed + i), layout, layer, name,
                        properties={"format-version": "2"} if layout.catalog else None)
            results.append({"table": name, "status": "created", "error": None})
        except Exception as e:  # noqa: BLE001 - isolation is the feature
            if on_error == "raise":
                raise
            results.append({"table": name, "status": "failed", "error": str(e)})
    return results
