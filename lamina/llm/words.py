"""Words of Arrow text columns as numpy arrays.

A word is a maximal run of digits, letters a-z (after A-Z are lower-cased) and bytes outside ASCII. In UTF-8 every
byte of a character outside ASCII is at least 0x80, so runs of bytes are runs of characters.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that are turned into arrays at a time; a longer text is taken whole, alone.
CHUNK_BYTES = 1 << 19
#: Bytes of text after which a worker gives freed memory back.
RELEASE_BYTES = 2 << 20
#: Estimated bytes of a table up to which it is dealt out anew before a pass over its texts.
SPREAD_BYTES = 16 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True

_MORE_THAN_A_SCAN = re.compile("Join|Aggregate|Repartition|Sort|Window|Distinct|Union|Limit|Generate|Python|Arrow")
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray, tag: int = 0) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    h = h + np.uint64(tag * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the hash's base and of its inverse modulo 2**64, at least n of each."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        tables = []
        for base in (_P, _P_INVERSE):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            tables.append(np.multiply.accumulate(row))
        if size > 8 * CHUNK_BYTES:  # not kept for one very long text
            return tables[0], tables[1]
        _powers[0] = (tables[0], tables[1])
    return _powers[0]


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column, one text after the other, and where each begins. Null counts as empty."""
    if texts.type != pa.large_string():
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


@dataclass
class Words:
    """Words of a run of texts; doc is the place of each word's text in the run."""

    lowered: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.offsets) - 1)

    @property
    def first(self) -> np.ndarray:
        """The place of each text's first word among all words, and one more for the end."""
        return np.concatenate(([0], np.cumsum(self.counts)))

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """64 bits for each word, or for its first bytes; equal for equal bytes."""
        n = len(self.lowered)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = powers(n + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum((self.lowered.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
            end = self.end if prefix is None else np.minimum(self.end, self.start + prefix)
            return mix((sums[end] - sums[self.start]) * down[self.start])

    def strings(self) -> pa.Array:
        """The words as an Arrow column."""
        keep = np.zeros(len(self.lowered) + 1, dtype=np.int32)
        np.add.at(keep, self.start, 1)
        np.add.at(keep, self.end, -1)
        inside = np.cumsum(keep[:-1]).astype(bool)
        offsets = np.concatenate(([0], np.cumsum(self.end - self.start))).astype(np.int64)
        data = np.ascontiguousarray(self.lowered[inside])
        return pa.LargeStringArray.from_buffers(len(self.start), pa.py_buffer(offsets), pa.py_buffer(data))


def find_words(texts: pa.Array) -> Words:
    data, offsets = text_buffer(texts)
    lowered = LOWER[data]
    word = IN_WORD[lowered]
    first = np.zeros(len(word) + 1, dtype=bool)
    first[offsets] = True
    before = np.empty_like(word)
    before[:1] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | first[:-1]))
    after = np.empty_like(word)
    after[-1:] = False
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | first[1:])) + 1
    return Words(lowered, offsets, start, end, np.searchsorted(offsets, start, side="right") - 1)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """64 bits for each k words in a row, beginning at each word but the last k - 1."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            out = out * np.uint64(_P) + hashes[j : j + n]
        return mix(out, k)


def sliced(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most so many bytes of text, or of one row."""
    sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def spread(df: DataFrame, small: int = SPREAD_BYTES) -> DataFrame:
    """A small table in a few partitions dealt out to all cores, as one file would keep one of them busy; others as they are."""
    cores, query = df.sparkSession.sparkContext.defaultParallelism, df._jdf.queryExecution()
    plan = query.optimizedPlan()
    if cores < 2 or int(str(plan.stats().sizeInBytes())) > small or _MORE_THAN_A_SCAN.search(plan.toString()):
        return df
    return df.repartition(cores) if query.toRdd().getNumPartitions() < 2 * cores else df


def two_columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text go on, under names of their own, whatever else the table has."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def map_texts(docs: DataFrame, fields: list[tuple[str, T.DataType]], make: Callable[[], Callable], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows made from each text, in one pass without a shuffle.

    make() runs once in each task and returns f(ids, texts), which gets Arrow columns of a bounded run of rows and
    returns a list of Arrow or numpy columns as fields has them.
    """
    own = two_columns(docs, id_col, text_col)
    schema = T.StructType([T.StructField(name, kind) for name, kind in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        f, done = make(), 0
        for batch in batches:
            for piece in sliced(batch, 1):
                done += piece.nbytes
                if done >= RELEASE_BYTES:
                    release()
                    done = 0
                columns = f(piece.column(0), piece.column(1))
                if columns is not None and len(columns[0]):
                    yield pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c)).cast(field.type) for c, field in zip(columns, arrow, strict=True)], schema=arrow)
        del f
        release()

    return spread(own).mapInArrow(run, schema)


def text_udf(make: Callable[[], Callable], kind: str | T.DataType):
    """A column function of a text column. make() runs once in each task and returns f(texts), which gets a bounded run
    of texts and returns a value for each."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        f, done = make(), 0
        for texts in columns:
            parts = []
            for piece in sliced(pa.RecordBatch.from_arrays([texts], names=["text"]), 0):
                parts.append(f(piece.column(0)))
                done += piece.nbytes
                if done >= RELEASE_BYTES:
                    release()
                    done = 0
            yield pa.concat_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in parts]) if parts else texts.slice(0, 0)
        del f
        release()

    return F.arrow_udf(run, kind)


def release() -> None:
    """Gives what a worker has freed back to the machine: it goes on to other tasks, and would hold its peak all along."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def id_type(docs: DataFrame, id_col: str) -> T.DataType:
    return docs.schema[id_col].dataType
