"""Concurrent steps of a layer run: every table whose inputs are ready is built at once.

Steps form a dependency graph. Those that are ready are submitted from threads, each under its own
scheduler pool (FAIR mode gives them equal shares of the cluster), so small tables don't wait for
large ones. A step that fails holds up only the steps that need it: these are skipped, all others run
on, and the outcome of every step is reported.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

OUTCOMES = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("rows_written", T.LongType()),
                         T.StructField("status", T.StringType()), T.StructField("error", T.StringType())])
WRITTEN, FAILED, SKIPPED = "written", "failed", "skipped"


@dataclass(frozen=True)
class Step:
    """``run`` makes the table ``name`` from the tables made so far, all of ``needs`` among them."""

    name: str
    run: Callable[[Mapping[str, DataFrame]], DataFrame]
    needs: tuple[str, ...] = ()


@dataclass(frozen=True)
class Outcome:
    name: str
    status: str
    table: DataFrame | None = None
    error: str | None = None


class LayerRunError(Exception):
    """Some steps failed; ``outcomes`` tells which, and what was written all the same."""

    def __init__(self, outcomes: Mapping[str, Outcome]):
        self.outcomes = dict(outcomes)
        super().__init__("; ".join(f"{o.name}: {o.status}" + (f" ({o.error})" if o.error else "")
                                   for o in self.outcomes.values() if o.status != WRITTEN))


def check_graph(steps: Iterable[Step]) -> list[Step]:
    """The steps in an order in which they could run one by one; raises on a name used twice, a need that no step makes, or a circle."""
    by = {}
    for s in steps:
        if s.name in by:
            raise ValueError(f"two steps make {s.name}")
        by[s.name] = s
    unknown = {(s.name, n) for s in by.values() for n in s.needs if n not in by}
    if unknown:
        raise ValueError(f"needs that no step makes: {sorted(unknown)}")
    order, left = [], dict(by)
    while left:
        ready = [s for s in left.values() if not any(n in left for n in s.needs)]
        if not ready:
            raise ValueError(f"steps that need each other: {sorted(left)}")
        order += ready
        for s in ready:
            del left[s.name]
    return order


def run_graph(spark: SparkSession, steps: Iterable[Step], workers: int = 4) -> dict[str, Outcome]:
    """Run the steps, up to ``workers`` at a time; the outcome of each by name, in a possible order of running.

    Only the number of tables bounds the threads' work: the data stays with the executors.
    """
    order = check_graph(steps)
    done: dict[str, Outcome] = {}
    running: dict[Future, Step] = {}

    def one(step: Step, tables: Mapping[str, DataFrame]) -> DataFrame:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", step.name)
        return step.run(tables)

    with ThreadPoolExecutor(max_workers=max(1, workers), thread_name_prefix="layer") as pool:
        while len(done) < len(order):
            for s in order:
                if s.name in done or s in running.values():
                    continue
                bad = [n for n in s.needs if n in done and done[n].status != WRITTEN]
                if bad:
                    done[s.name] = Outcome(s.name, SKIPPED, error=f"needs {', '.join(bad)}")
                elif all(n in done for n in s.needs):
                    tables = {n: o.table for n, o in done.items() if o.status == WRITTEN}
                    running[pool.submit(inheritable_thread_target(spark)(one), s, tables)] = s
            if not running:
                continue
            for f in wait(running, return_when=FIRST_COMPLETED).done:
                s, e = running.pop(f), f.exception()
                if e is not None and not isinstance(e, Exception):
                    raise e  # an interrupt ends the run
                done[s.name] = Outcome(s.name, FAILED, error=f"{type(e).__name__}: {e}") if e else Outcome(s.name, WRITTEN, f.result())
    return {s.name: done[s.name] for s in order}


def outcome_table(spark: SparkSession, outcomes: Mapping[str, Outcome]) -> DataFrame:
    """``table_name, rows_written, status, error`` of a run, one row per step; rows are counted in the written tables."""
    rows = [(o.name, o.table.count() if o.table is not None else None, o.status, o.error) for o in outcomes.values()]
    return spark.createDataFrame(rows, OUTCOMES)
