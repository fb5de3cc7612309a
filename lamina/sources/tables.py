"""Layers of tables as Parquet folders, <root>/<layer>/<table>, on any file system or object store that Hadoop reaches.

A table that is replaced has its rows in a version folder, <table>/v<number>-<id>, and a mark beside it, <table>/_at-<number>-<id>,
that is made once the version is complete and checked. The greatest mark says which version is read, so there is no time in
which the table is missing, and nothing is renamed. Tables that several writers add to have their files in folders p-<id> and numbered
commits that name them (commits.py).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.checkpoints import SMALL_ROWS, cut, stored
from lamina.operators.checks import ConstraintError, require_not_null, require_unique
from lamina.operators.ids import numbered
from lamina.operators.latest import distinct_content
from lamina.sources import filters
from lamina.sources.commits import Commits, State

_MARK = "_at-"
#: Payloads and hashes are texts, which take about half of what they do with Spark's default.
CODEC = "zstd"
#: Rows of a file at most, which bounds its filter of hashes.
FILE_ROWS = 5_000_000
#: And of a file that upserts write: a key of theirs costs so many rows at most.
UPSERT_ROWS = 500_000


@dataclass
class Tables:
    spark: SparkSession
    root: str

    def folder(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _files(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._files(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self, layer: str, table: str) -> list[str]:
        """The published versions, the current one last."""
        return [n.removeprefix(_MARK) for n in self._names(self.folder(layer, table)) if n.startswith(_MARK)]

    def path(self, layer: str, table: str) -> str:
        """Where the table's current rows are."""
        folder, versions = self.folder(layer, table), self.versions(layer, table)
        return f"{folder}/v{versions[-1]}" if versions else folder

    def exists(self, layer: str, table: str) -> bool:
        """Whether the table was written to its end."""
        names = self._names(self.folder(layer, table))
        return "_SUCCESS" in names or any(n.startswith((_MARK, "_c-")) for n in names)

    def layer_exists(self, layer: str) -> bool:
        fs, p = self._files(f"{self.root}/{layer}")
        return fs.exists(p)

    def list(self, layer: str) -> list[str]:
        """Names of the layer's tables, sorted."""
        return [n for n in self._names(f"{self.root}/{layer}") if not n.startswith((".", "_")) and self.exists(layer, n)]

    def read(self, layer: str, table: str) -> DataFrame:
        commits = self.commits(layer, table)
        if commits.any() and not self.versions(layer, table):  # a version takes the place of all that was added before
            return self._of_files(layer, table, commits.state().files)
        return self.spark.read.parquet(self.path(layer, table))

    def commits(self, layer: str, table: str) -> Commits:
        return Commits(self.spark, self.folder(layer, table))

    def _of_files(self, layer: str, table: str, files: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.folder(layer, table)}/{f}" for f in files])

    def replace(self, layer: str, table: str, df: DataFrame, check=None) -> DataFrame:
        """Writes df as a new version, checks what was written, and publishes it; on an error the old version stays.

        The version before stays for those who are reading it; older ones go.
        """
        folder, old = self.folder(layer, table), self.versions(layer, table)
        name = f"{int(old[-1].split('-')[0]) + 1 if old else 1:012d}-{uuid.uuid4().hex}"
        fs, p = self._files(f"{folder}/v{name}")
        try:
            df.write.option("compression", CODEC).parquet(f"{folder}/v{name}")
            if check:
                check(self.spark.read.parquet(f"{folder}/v{name}"))
        except BaseException:
            fs.delete(p, True)
            if not self._names(folder):
                fs.delete(self._files(folder)[1], True)
            raise
        fs.create(self._files(f"{folder}/{_MARK}{name}")[1], False).close()
        kept = {f"{mark}{v}" for v in (*old[-1:], name) for mark in (_MARK, "v")}
        for n in self._names(folder) if old else []:
            number = n.removeprefix(_MARK).removeprefix("v").split("-")[0]
            if n not in kept and not (number.isdigit() and int(number) >= int(name.split("-")[0])):  # another writer's stay
                fs.delete(self._files(f"{folder}/{n}")[1], True)
        self.spark.catalog.refreshByPath(folder)
        return self.read(layer, table)

    def _growing(self, layer: str, table: str) -> Commits:
        """The commits of a table that is added to; an error for one that is replaced whole."""
        if self.versions(layer, table):
            raise ValueError(f"{layer}.{table} is replaced whole, so it has no commits")
        return self.commits(layer, table)

    def _add(self, layer: str, table: str, df: DataFrame, file_rows: int = FILE_ROWS) -> tuple[str, list[str]]:
        """Writes rows to a new folder of the table; its name and its files, which count once a commit names them."""
        name, commits = f"p-{uuid.uuid4().hex}", self.commits(layer, table)
        df.write.option("maxRecordsPerFile", file_rows).option("compression", CODEC).parquet(f"{self.folder(layer, table)}/{name}")
        return name, [f"{name}/{n}" for n in commits.names(name) if n.startswith("part-")]

    def append(self, layer: str, table: str, df: DataFrame, batch: tuple[str, int] | None = None) -> None:
        """Adds rows. batch: a stream and the number of its batch, which is added once however often it is run."""
        if self.versions(layer, table):
            path = self.path(layer, table)
            df.write.mode("append").option("compression", CODEC).parquet(path)
            self.spark.catalog.refreshByPath(path)
            return
        commits = self.commits(layer, table)
        if batch and commits.state().batches.get(batch[0], -1) >= batch[1]:
            return
        name, files = self._add(layer, table, df)
        while True:
            state = commits.state()
            if batch and state.batches.get(batch[0], -1) >= batch[1]:
                return commits.delete(name)
            if commits.put(state, add=files, batches=dict([batch] if batch else [])):
                return None

    def may_hold(self, layer: str, table: str, state: State, hashes: DataFrame) -> list[str]:
        """The table's files that may hold a hash of the column: all without a filter, and those whose filter does not deny it."""
        if not state.files or hashes.limit(filters.LOOKUPS + 1).count() > filters.LOOKUPS:
            return state.files
        asked = hashes.select(F.xxhash64(hashes.columns[0]).alias("h")).toArrow().column("h").to_numpy()
        tables, known, held = state.facts.get("filters", []), set(), set()
        if tables:
            kept = self._of_files(layer, table, tables)
            known = {r.file for r in kept.select("file").collect()}  # names of files
            held = set(filters.files_holding(kept, asked))
        return [f for f in state.files if f.split("/")[-1] in held or f.split("/")[-1] not in known]

    def append_new(
        self, layer: str, table: str, rows: DataFrame, order: Sequence[Column], number: str = "bronze_row_id", hash_col: str = "hash_key", drop: Sequence[str] = (), row: str | None = None
    ) -> int:
        """Adds the rows of new content, numbered from the table's greatest number on; how many.

        Of equal content the first row in the order counts; rows without a hash are all new. Filters of the files say which of them may hold one of the hashes; only these files'
        hashes are read. If another writer has committed meanwhile, what is new is found again after its rows, so two runs over the same
        content add it once, and no number is given twice. drop: columns that only serve the order. row: a column, not written, with a number of each row's own that is the same however
        often rows are computed; without it they are stored with one. So hashes, places and numbers are found without the other columns, which are
        shuffled once, to the numbers.
        """
        if row is None:
            with stored(rows.withColumn("_row", F.monotonically_increasing_id())) as kept:
                return self.append_new(layer, table, kept, order, number, hash_col, drop, "_row")
        once, commits = cut(distinct_content(rows, hash_col, order).select(row, hash_col)), self._growing(layer, table)
        while True:
            state, there = commits.state(), self.exists(layer, table)
            files = self.may_hold(layer, table, state, once.filter(F.col(hash_col).isNotNull()).select(hash_col))
            new = once.join(self._of_files(layer, table, files).select(hash_col), hash_col, "left_anti") if files else once
            top = state.top or (self.read(layer, table).agg(F.max(number)).first()[0] or 0 if state.files else 0)
            numbers = numbered(rows.join(new.select(row), row, "left_semi"), order, number, top + 1, keep=[row])
            delta = rows.join(numbers, row).drop(row, *drop)
            name, written = self._add(layer, table, delta.select(number, *[c for c in delta.columns if c != number]))
            n = self._of_files(layer, table, written).count()
            if not n and there:
                commits.delete(name)
                return 0
            facts = f"_b-{name}"
            made = filters.filters_of(self._of_files(layer, table, written), hash_col)
            made.write.option("parquet.block.size", 32 << 20).parquet(f"{self.folder(layer, table)}/{facts}")
            if commits.put(state, add=written, facts={"filters": [facts]}, top=top + n):
                return n
            commits.delete(name)
            commits.delete(facts)

    def upsert(self, layer: str, table: str, delta: DataFrame, keys: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None, batch: tuple[str, int] | None = None) -> list[str]:
        """Puts delta's rows in place of those of equal keys, null parts being equal, and adds the others; the files rewritten.

        merge: what makes the new rows of the old ones of delta's keys and delta, where they don't just replace them. batch: a stream and
        the number of its batch, which counts once however often it is run.

        Files keep the range of their keys beside them. Those whose range no key of delta falls in are not opened; of the others the keys are read, and only files that hold
        one of delta's keys are written anew, less those rows. All other files stay as they are, under their names. Delta's keys have to be unique. If another writer has
        committed meanwhile, all is done again after it.
        """
        delta, commits = require_unique(cut(delta), keys, table), self._growing(layer, table)
        wanted = delta.select(*keys)
        while True:
            state = commits.state()
            if batch and state.batches.get(batch[0], -1) >= batch[1]:
                return []
            rows, touched = delta, []
            if likely := self._in_range(layer, table, state, wanted, keys):
                names = {r._file for r in self._held(layer, table, likely, wanted, keys).select("_file").distinct().collect()}  # names of files
                touched = [f for f in likely if f in names or f"{table}/{f}" in names]
            if touched:
                old = self._of_files(layer, table, touched)
                same = [old[k].eqNullSafe(wanted[k]) for k in keys]
                fresh = merge(old.join(wanted, same, "left_semi"), delta) if merge else delta
                rows = old.join(wanted, same, "left_anti").unionByName(fresh, allowMissingColumns=True)
            name, facts, written = self._add_ranged(layer, table, rows, keys)
            if commits.put(state, add=written, remove=touched, facts={"ranges": [facts]}, batches=dict([batch] if batch else [])):
                return touched
            commits.delete(name)
            commits.delete(facts)

    def insert(self, layer: str, table: str, delta: DataFrame, keys: Sequence[str], not_null: Sequence[str] = ()) -> None:
        """Adds delta's rows, or raises ConstraintError and adds none, if a key would occur twice (null parts being equal) or a column of not_null holds a null.

        Only delta is checked in whole; of the table the keys of files are read in whose range one of delta's falls.
        """
        delta, commits = require_not_null(require_unique(cut(delta), keys, table), not_null, table), self._growing(layer, table)
        wanted = delta.select(*keys)
        while True:
            state = commits.state()
            if likely := self._in_range(layer, table, state, wanted, keys):
                twice = self._held(layer, table, likely, wanted, keys).select(*keys).limit(3).collect()
                if twice:
                    raise ConstraintError(f"{table}: {', '.join(keys)} not unique: {[tuple(r) for r in twice]}")
            name, facts, written = self._add_ranged(layer, table, delta, keys)
            if commits.put(state, add=written, facts={"ranges": [facts]}):
                return
            commits.delete(name)
            commits.delete(facts)

    def _held(self, layer: str, table: str, files: Sequence[str], wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Keys of the files that are wanted, with the file (folder and name) that each is in."""
        file = F.concat_ws("/", F.slice(F.split("_metadata.file_path", "/"), -2, 2)).alias("_file")
        held = self._of_files(layer, table, files).select(file, *keys)
        return held.join(wanted, [held[k].eqNullSafe(wanted[k]) for k in keys], "left_semi")

    def _add_ranged(self, layer: str, table: str, rows: DataFrame, keys: Sequence[str]) -> tuple[str, str, list[str]]:
        """Writes rows in files by ranges of their keys, and the ranges beside them: both folders, and the files."""
        name, written = self._add(layer, table, rows.repartitionByRange(*keys).sortWithinPartitions(*keys), UPSERT_ROWS)
        facts, key, file = f"_r-{name}", F.struct(*keys), F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file")
        self._of_files(layer, table, written).groupBy(file).agg(F.min(key).alias("low"), F.max(key).alias("high")).write.parquet(f"{self.folder(layer, table)}/{facts}")
        return name, facts, written

    def _in_range(self, layer: str, table: str, state: State, wanted: DataFrame, keys: Sequence[str]) -> list[str]:
        """The table's files in whose range of keys one of the wanted falls, and those without a known range."""
        tables = state.facts.get("ranges", [])
        if not tables or not state.files:
            return state.files
        ranges = cut(self._of_files(layer, table, tables))
        known = {r.file for r in ranges.select("file").collect()}  # names of files
        if len(known) > SMALL_ROWS:
            return state.files  # too many ranges to send to all tasks
        key = F.struct(*keys)
        near = wanted.join(F.broadcast(ranges), (key >= F.col("low")) & (key <= F.col("high"))).select("file").distinct()
        found = {r.file for r in near.collect()}
        return [f for f in state.files if f.split("/")[-1] in found or f.split("/")[-1] not in known]

    def drop(self, layer: str, table: str) -> None:
        fs, p = self._files(self.folder(layer, table))
        fs.delete(p, True)
