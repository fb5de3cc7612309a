"""Bloom filters of the hashes in a table's files: which files may hold one of some hashes, without reading them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter for each row of a file, and probes for each hash: one of 70,000 absent hashes is not told from a present one.
BITS, PROBES = 24, 12
#: Hashes up to which files are looked up, as the tasks get all of them; more are compared with all files.
LOOKUPS = 1_000_000


def _probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each hash, a column for each probe."""
    first = hashes.view(np.uint64)
    second = (first * np.uint64(0x9E3779B97F4A7C15) ^ (first >> np.uint64(29))) | np.uint64(1)
    return (first[:, None] + np.arange(PROBES, dtype=np.uint64)[None, :] * second[:, None]) % np.uint64(bits)


def filters_of(rows: DataFrame, hash_col: str) -> DataFrame:
    """(file, bits) for rows that were read from files: a filter of each file's hashes that are not null."""
    hashed = rows.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.xxhash64(hash_col).alias("h"), F.col(hash_col).isNotNull().alias("there"))

    def make(key: tuple, held: pa.Table) -> pa.Table:
        h = held.column("h").to_numpy()[held.column("there").to_numpy()]
        bits = np.zeros(max(64, BITS * len(h) + 7 >> 3 << 3), dtype=bool)
        for at in range(0, len(h), 65_536):
            bits[_probes(h[at : at + 65_536], len(bits)).ravel().astype(np.int64)] = True
        return pa.table({"file": [key[0].as_py()], "bits": [np.packbits(bits).tobytes()]})

    return hashed.groupBy("file").applyInArrow(make, "file string, bits binary")


def files_holding(filters: DataFrame, hashes: np.ndarray) -> list[str]:
    """Files that may hold one of the hashes (xxhash64 values), by their filters. Few hashes go to all tasks; a filter is never gathered."""
    shared = filters.sparkSession.sparkContext.broadcast(hashes)  # at most LOOKUPS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for file, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                bits = np.unpackbits(np.frombuffer(packed.as_buffer(), np.uint8)).astype(bool)
                for at in range(0, len(shared.value), 65_536):
                    if bits[_probes(shared.value[at : at + 65_536], len(bits)).astype(np.int64)].all(axis=1).any():
                        hit.append(file)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(hit, pa.string())], names=["file"])

    return sorted(r.file for r in filters.select("file", "bits").mapInArrow(run, "file string").collect())  # names of files
