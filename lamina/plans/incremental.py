"""Amendment histories folded as postings come, without reading the postings of before."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.operators.amendments import NullRule, fold_counts, fold_state, folded, merge_states
from lamina.sources.tables import Tables


@dataclass
class AmendmentFold:
    """The fold of all postings added so far, in two tables: a state for each key, and counts of postings for each key and time.

    Postings may come in any order and any batches; the result is fold() of all of them. A batch reads and rewrites only the files that
    hold its keys (Tables.upsert), and counts once for each of the tables, so one that stopped half way is just added again.
    """

    tables: Tables
    layer: str
    name: str
    keys: Sequence[str]
    columns: Sequence[str]
    description: Column | str
    posted: Column
    tie_break: Sequence[Column]
    rule: NullRule | None = None
    orphans: bool = True

    def add(self, postings: DataFrame, batch: tuple[str, int] | None = None) -> None:
        keys, timed = list(self.keys), [*self.keys, "_posted"]
        states = fold_state(postings, keys, self.columns, self.description, self.posted, self.tie_break, self.rule)
        self.tables.upsert(self.layer, f"{self.name}_state", states, keys, lambda old, new: merge_states(old.unionByName(new), keys, self.rule), batch)
        counts = fold_counts(postings, keys, self.posted)
        self.tables.upsert(self.layer, f"{self.name}_counts", counts, timed, lambda old, new: old.unionByName(new).groupBy(*timed).agg(F.sum("_n").alias("_n")), batch)

    def current(self) -> DataFrame:
        """One row per key, as fold() has it."""
        states, counts = (self.tables.read(self.layer, f"{self.name}_{part}") for part in ("state", "counts"))
        return folded(states, counts, self.keys, self.rule, self.orphans)
