"""Monthly marts kept up to date load by load, without reading old rows again.

Every load leaves its mergeable partials (sums, counts, least and greatest
values, counts per label) in a state table with one folder per month and load.
A mart's month is rebuilt from the partials of that month alone, and only the
months that a load touches are read and overwritten.

- A load that runs again overwrites its own folders, so nothing counts twice; a
  load lost between its state and its mart is completed by running it again. A
  load's name stands for one fixed set of rows.
- Loads of one mart run one after another: of two at once, the mart might show
  the partials of one only, until the next load of that month.
- The driver holds the months of one load, never rows. A month's state has a row
  per load and combination of labels, so name loads by day rather than by minute.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.plans import gold
from contrail.sources.layout import Layout, read_table, replace_partitions, table_exists

PERIOD = gold.PERIOD
#: Aggregates that merge with themselves; a count merges as the sum of counts.
MERGE = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}
TAKE = {**MERGE, "count": F.count}


@dataclass(frozen=True)
class State:
    """A table of partials: label columns beside the month, and an aggregate and column per measure."""

    name: str
    labels: tuple[str, ...]
    measures: dict[str, tuple[str, str]]

    def take(self, rows: DataFrame) -> DataFrame:
        """Partials of ``rows(year, month, labels, columns)``."""
        return rows.groupBy(*PERIOD, *self.labels).agg(*[TAKE[how](c).alias(m) for m, (how, c) in self.measures.items()])

    def merge(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy(*PERIOD, *self.labels).agg(*[MERGE[how](m).alias(m) for m, (how, _) in self.measures.items()])


#: Departures have no reason and count seconds, reasons count events: both in one row per month and label.
DELAYS = State("state_monthly_delays", ("delay_reason",), {
    "delays": ("count", "seconds"), "seconds": ("sum", "seconds"), "least": ("min", "seconds"), "most": ("max", "seconds"),
    "total_occurences": ("count", "event")})
ROUTES = State("state_booked_routes", ("airport_origin", "airport_destination", "method"), {"bookings": ("sum", "bookings")})


def in_months(months: list[tuple[int | None, int | None]]) -> Column:
    """Rows of the months, by the partition columns alone; rows without a month are a month of their own."""
    number = F.coalesce(F.col("year") * 12 + F.col("month"), F.lit(-1))
    return number.isin([-1 if y is None or m is None else y * 12 + m for y, m in months])


def read_state(spark: SparkSession, layout: Layout, state: State, months: list | None = None) -> DataFrame | None:
    """The stored partials (of the months given), or None if no load has left any."""
    if not table_exists(spark, layout, "gold", state.name):
        return None
    stored = read_table(spark, layout, "gold", state.name)
    return stored if months is None else stored.where(in_months(months))


def _by_month(df: DataFrame) -> DataFrame:
    """A month's rows in one task; a fixed number of tasks, since the cost is files to open, which sizes don't tell AQE."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *PERIOD)


def add_load(spark: SparkSession, layout: Layout, state: State, rows: DataFrame, load: str) -> list[tuple[int | None, int | None]]:
    """Store the load's partials in place of what it stored before; returns the months it has now."""
    partials = state.take(rows).withColumn("load", F.lit(f"load-{load}"))  # never read back as a number or date
    replace_partitions(_by_month(partials), layout, "gold", state.name, [*PERIOD, "load"])
    stored = read_state(spark, layout, state)
    if stored is None:
        return []
    return [(r.year, r.month) for r in stored.where(F.col("load") == f"load-{load}").select(*PERIOD).distinct().collect()]


def refresh(layout: Layout, name: str, mart: DataFrame) -> None:
    """Overwrite the mart's months that ``mart`` has; the others stay as they are."""
    replace_partitions(_by_month(mart), layout, "gold", name, PERIOD)


def delays_mart(spark: SparkSession, layout: Layout, months: list | None = None, audit: bool = True) -> DataFrame:
    """T18 of the months given (all: None) from the stored partials."""
    merged = DELAYS.merge(read_state(spark, layout, DELAYS, months))
    stats = merged.where(F.col("delay_reason").isNull()).select(
        *PERIOD, (F.try_divide("seconds", "delays") / 60.0).alias("average_delay"),
        (F.col("least") / 60.0).alias("minimal_delay"), (F.col("most") / 60.0).alias("maximal_delay"))
    return gold.delays_of(stats, merged.where(F.col("delay_reason").isNotNull()), audit=audit)


def add_delays(spark: SparkSession, layout: Layout, load: str, flights_events: DataFrame, flights: DataFrame, audit: bool = True) -> list:
    """Bring ``gold_dim_monthly_delays`` up to date with one load of events; returns the months rebuilt.

    ``flights`` holds the flights of the load's events at least; events of unknown flights are left out, as in the full build.
    """
    months = add_load(spark, layout, DELAYS, gold.delay_rows(flights, flights_events), load)
    if months:
        refresh(layout, "gold_dim_monthly_delays", delays_mart(spark, layout, months, audit))
    return sorted(months, key=str)


def popular_mart(spark: SparkSession, layout: Layout, months: list | None = None, audit: bool = True) -> DataFrame:
    """T21 of the months given (all: None) from the stored partials."""
    return gold.popular_of(ROUTES.merge(read_state(spark, layout, ROUTES, months)).withColumnRenamed("bookings", "_w"), audit=audit)


def add_bookings(spark: SparkSession, layout: Layout, load: str, booked_tickets: DataFrame, flights: DataFrame, routes: DataFrame,
                 key: str = "flight", method: str = "column", audit: bool = True) -> list:
    """Bring ``gold_dim_monthly_most_popular`` up to date with one load of bookings; returns the months rebuilt."""
    counts = gold.booked_routes(booked_tickets, flights, routes, key, method).withColumnRenamed("_w", "bookings")
    months = add_load(spark, layout, ROUTES, counts, load)
    if months:
        refresh(layout, "gold_dim_monthly_most_popular", popular_mart(spark, layout, months, audit))
    return sorted(months, key=str)
