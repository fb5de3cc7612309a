"""Builds tables in the order of what they read."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.checkpoints import shed
from lamina.operators.checks import require_not_null, require_unique
from lamina.operators.ids import renumbered
from lamina.operators.quarantine import set_aside
from lamina.plans.registry import Plan, Registry, in_group
from lamina.sources.export import Export, export_for_stage
from lamina.sources.labels import feed_name
from lamina.sources.tables import Tables

log = logging.getLogger(__name__)

#: The layer with the cells that did not cast.
REJECTED = "rejected"
#: Tables that are built at a time.
AT_ONCE = 6


@dataclass
class Result:
    """How one table went: succeeded, skipped or failed."""

    name: str
    status: str
    rows: int = 0
    seconds: float = 0.0
    error: str = ""


def selected(registry: Registry, group: str | None = None, source: str | None = None) -> list[str]:
    """Names of the plans in a group of folders and of a feed, sorted."""
    names = sorted(registry)
    if group is not None:
        names = [n for n in names if in_group(registry[n], group)]
    if source is not None:
        names = [n for n in names if feed_name(registry[n].feed) == feed_name(source)]
    return names


def ordered(registry: Registry, names: Iterable[str]) -> list[str]:
    """The names with every table after the tables it reads; a cycle is an error."""
    names, maker = sorted(names), {(p.layer, p.table): n for n, p in registry.items()}
    out, state = [], {}

    def visit(n: str) -> None:
        if state.get(n) == "open":
            raise ValueError(f"{n} reads itself")
        if n not in state:
            state[n] = "open"
            for source in (*registry[n].sources, *registry[n].optional):
                if maker.get(source) in registry:
                    visit(maker[source])
            state[n] = "done"
            out.append(n)

    for n in names:
        visit(n)
    return [n for n in out if n in set(names)]


def missing_sources(plan: Plan, tables: Tables) -> list[str]:
    return [f"{layer}.{table}" for layer, table in plan.sources if not tables.exists(layer, table)] if plan.sources_required else []


def rows_of(plan: Plan, tables: Tables, rejected: list[DataFrame] | None = None) -> DataFrame | None:
    """The plan's rows from the tables that are there, without number and time of load.

    Rows of a source with a cell that does not cast are left out; rejected gets a table of such cells for each source.
    """
    there = {table: tables.read(layer, table) for layer, table in (*plan.sources, *plan.optional) if tables.exists(layer, table)}
    for table, casts in plan.casts.items():
        if table in there and casts:
            there[table], errors = set_aside(there[table], casts)
            if rejected is not None:
                rejected.append(errors.select(F.lit(table).alias("source"), "*"))
    return plan.build(there)


def run_one(name: str, registry: Registry, tables: Tables, reload: bool = False, to: Export | None = None) -> Result:
    """Builds one table: skipped if it is there and reload is off, or if a source is missing.

    Rows are written beside the old table, checked for key and nulls, and swapped in, so a failure leaves the old table. On reload
    rows keep the numbers that they have there. Rows of a source with a cell that does not cast are set aside: the table of this name in the
    layer REJECTED lists the cells.
    A plan without anything to build succeeds with no rows; on reload its old table goes.
    """
    plan, began = registry[name], time.perf_counter()
    done = lambda status, rows=0, error="": Result(name, status, rows, time.perf_counter() - began, error)
    try:
        if missing := missing_sources(plan, tables):
            return done("skipped", error=f"missing {', '.join(missing)}")
        if tables.exists(plan.layer, plan.table) and not reload:
            return done("skipped", error="there already")
        rejected: list[DataFrame] = []
        rows = rows_of(plan, tables, rejected)
        if rows is None:
            tables.drop(plan.layer, plan.table)
            return done("succeeded")
        if plan.surrogate:
            rows = renumbered(rows, tables.read(plan.layer, plan.table) if tables.exists(plan.layer, plan.table) else None, plan.key, plan.surrogate)
            rows = rows.select(plan.surrogate, *[c for c in rows.columns if c != plan.surrogate])
        if plan.stamp:
            rows = rows.withColumn(plan.stamp, F.current_timestamp())

        def check(written: DataFrame) -> None:
            require_not_null(written, plan.not_null, plan.table)
            if plan.key:
                require_unique(written, plan.key, plan.table, plan.nulls_distinct)

        written = tables.replace(plan.layer, plan.table, rows, check)
        bad = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rejected) if rejected else None
        if bad is not None and (tables.exists(REJECTED, plan.table) or not bad.isEmpty()):
            listed = tables.replace(REJECTED, plan.table, bad)
            log.warning("%s: %d bad cells set aside", name, listed.count())
        if to:
            export_for_stage(written, plan.table, to if to.stage else to.for_stage(plan.group.split("/")[0]), plan.feed)
        return done("succeeded", written.count())
    except Exception as e:  # one table's failure leaves the others
        log.exception("%s failed", name)
        return done("failed", error=f"{type(e).__name__}: {e}")


def run_many(registry: Registry, tables: Tables, names: Iterable[str] | None = None, reload: bool = False, to: Export | None = None, at_once: int = AT_ONCE, kept: Iterable[str] | None = None) -> list[Result]:
    """Builds the tables, each as soon as those that it reads are there, at most at_once at a time; the results are in order.

    Tables that read one that failed in this run are skipped. Each table's jobs are in a scheduler pool of its own, so that with fair
    scheduling a small table doesn't wait for a large one. A run that was lost goes on with what it had not published.
    kept: the tables that stay, by their plans' names, where the others only serve them: each of those goes once all that read it are built. All stay
    without it, and those that a failed or skipped one reads.
    """
    order = ordered(registry, registry if names is None else names)
    maker = {(registry[n].layer, registry[n].table): n for n in order}
    reads = {n: {*registry[n].sources, *registry[n].optional} for n in order}
    waits = {n: {maker[t] for t in reads[n] if t in maker} - {n} for n in order}
    results: dict[str, Result] = {}
    failed, waiting, going = set(), list(order), {}
    passing = {} if kept is None else {t: [r for r in order if t in reads[r]] for t, n in maker.items() if n not in set(kept)}

    def build(name: str) -> Result:
        tables.spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return run_one(name, registry, tables, reload, to)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        while waiting or going:
            for name in [n for n in waiting if waits[n] <= results.keys()]:
                waiting.remove(name)
                if bad := failed & reads[name]:
                    results[name] = Result(name, "skipped", error=f"failed before: {', '.join(t for _, t in sorted(bad))}")
                    failed.add((registry[name].layer, registry[name].table))
                else:
                    going[pool.submit(build, name)] = name
            for done in wait(going, return_when=FIRST_COMPLETED).done if going else ():
                name = going.pop(done)
                results[name] = done.result()
                if results[name].status == "failed":
                    failed.add((registry[name].layer, registry[name].table))
                for t in [t for t, readers in passing.items() if readers and all(r in results and results[r].status == "succeeded" for r in readers)]:
                    tables.drop(*t)
                    del passing[t]
            shed(tables.spark)  # shuffle files of what was built, which a large heap would keep until the end
    return [results[n] for n in order]


def summary(results: Iterable[Result]) -> dict[str, int]:
    """How many tables went which way, and the rows written."""
    out = {"succeeded": 0, "skipped": 0, "failed": 0, "rows": 0}
    for r in results:
        out[r.status] += 1
        out["rows"] += r.rows
    return out
