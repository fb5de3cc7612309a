"""Files of token ids: documents in the order of their ids, encoded by rans.py, with an index of where each one lies."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lamina.llm import rans
from lamina.llm.store import cut, shared_dir
from lamina.llm.words import id_type, release, sliced, two_columns

#: Ids of a frame, in whole documents; a longer document is a frame by itself.
FRAME_IDS = rans.BLOCK
#: Estimated bytes of the documents of a file, and bytes of a row group of it.
FILE_BYTES, GROUP_BYTES = 128 << 20, 32 << 20
#: Spark says so many bytes, or more, of a table whose size it can't tell.
UNKNOWN = 1 << 52
#: Pieces between single spaces whose ids a worker keeps, in each of two generations, and the longest one in characters.
KEPT, KEPT_LENGTH = 400_000, 48
#: Bytes of text that are encoded at a time, or one longer text alone.
CHUNK_BYTES = 8 << 20
#: A word and what follows it in a piece: the split ends a word before an ASCII character that is no letter.
PARTS = "(?s)^(?P<word>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+)(?P<tail>[\\x00-@\\[-`{-\\x7f].*)$"
#: What stands for a space in the vocabulary of a byte-level file.
SPACE = "\u0120"


class Encoder:
    """The ids that a byte-level BPE file gives for texts.

    The file's split never joins characters on both sides of a single space, and begins a piece there. So a text is cut at single
    spaces between characters that are no white space, and the ids of a piece, with its space, are the same wherever it stands: the
    library encodes each different piece once, many in a run, where a token with a space at its head begins each. Of a piece that is a
    word and something else (PARTS) both are encoded apart, for the split ends the word there. Pieces that begin
    or end with anything but a letter, digit or ASCII sign go to the library together with their neighbours, and texts with a
    special token's string as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab()
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.begins[[i for t, i in vocabulary.items() if t.startswith(SPACE)]] = True
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}  # what was used before lately
        self.tails: dict[str, bytes] = {"": b""}  # what follows words, without a space before it

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def safe(piece: str) -> bool:
        if not piece:
            return False
        a, z = piece[0], piece[-1]
        return (a.isalnum() or "!" <= a <= "~") and (z.isalnum() or "!" <= z <= "~")

    def learn(self, pieces: list[str]) -> None:
        """Keeps the ids of pieces, each with a space before it."""
        runs = [pieces[at : at + 256] for at in range(0, len(pieces), 256)]
        for run, ids in zip(runs, self.whole([" " + " ".join(r) for r in runs])):
            ends = np.append(np.flatnonzero(self.begins[ids]), len(ids)) * 4
            data = ids.tobytes()
            self.known.update({p: data[a:b] for p, a, b in zip(run, ends[:-1].tolist(), ends[1:].tolist(), strict=True)})

    def learn_new(self, pieces: list[str]) -> None:
        """Has the ids of the pieces kept, but of unsafe and of long ones."""
        if len(self.known) > KEPT:
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        new = [p for p in pieces if p not in known]
        known.update({p: old[p] for p in new if p in old})
        self.learn([p for p in new if p not in known and len(p) <= KEPT_LENGTH and (p.isalnum() or self.safe(p))])

    def learn_tails(self, tails: list[str]) -> None:
        """Has the ids of what follows words kept, but of what ends unsafely and of long ones."""
        if len(self.tails) > KEPT:
            self.tails = {"": b""}
        new = [t for t in tails if t not in self.tails and len(t) <= KEPT_LENGTH and self.safe("a" + t)]
        self.tails.update(zip(new, (x.tobytes() for x in self.whole(new))))

    def kept(self, piece: str) -> bytes | None:
        """The ids of a piece with a space before it, if they are kept."""
        ids = self.known.get(piece)
        if ids is None and (m := re.match(PARTS, piece)):
            word, tail = self.known.get(m[1]), self.tails.get(m[2])
            return None if word is None or tail is None else word + tail
        return ids

    def pieced(self, texts: list[str]) -> list[bytes]:
        """Of each text without special tokens the ids, cut at safe spaces only."""
        out, late, spots, safe = [], [], [], self.safe
        for i, text in enumerate(texts):
            pieces = text.split(" ")
            got, end, n = list(map(self.kept, pieces)), 0, len(pieces)
            got[0] = None  # no space before it
            for at in [k for k, ids in enumerate(got) if ids is None]:
                if at < end:
                    continue
                if at and not safe(pieces[at]):
                    at -= 1
                end = at + 1
                while end < n and not (safe(pieces[end - 1]) and safe(pieces[end])):
                    end += 1
                late.append((" " if at else "") + " ".join(pieces[at:end]))
                spots.append((i, at, end))
            out.append(got)
        for (i, at, end), ids in zip(spots, self.whole(late)):
            out[i][at:end] = [ids.tobytes()] + [b""] * (end - at - 1)
        return [b"".join(got) for got in out]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Of each text the ids as little-endian u32; none of a null or empty one.

        Pieces are told apart and put together again by Arrow, so that Python meets each different one once; texts with an unsafe piece,
        or one that is not kept, are put together one by one.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        if not len(texts):
            return []
        lists = pc.split_pattern(texts, " ")
        starts, flat = lists.offsets.to_numpy()[:-1].astype(np.int64), lists.flatten().dictionary_encode()
        place, values = flat.indices.to_numpy(), flat.dictionary
        rest = np.ones(len(place), dtype=bool)
        rest[starts] = False  # the first piece of a text has no space before it
        spaced = np.zeros(len(values), dtype=bool)
        spaced[place[rest]] = True
        parts = pc.extract_regex(values, PARTS)
        heads = pc.coalesce(pc.struct_field(parts, "word"), values).dictionary_encode()
        ends = pc.struct_field(parts, "tail").fill_null("").dictionary_encode()
        head, words, tail, tails = heads.indices.to_numpy(), heads.dictionary.to_pylist(), ends.indices.to_numpy(), ends.dictionary.to_pylist()
        wanted = np.zeros(len(words), dtype=bool)
        wanted[head[spaced]] = True
        self.learn_new([words[n] for n in np.flatnonzero(wanted).tolist()])
        self.learn_tails(tails)
        word_ids, tail_ids = list(map(self.known.get, words)), list(map(self.tails.get, tails))
        lost, loose = [n for n, x in enumerate(word_ids) if x is None], [n for n, x in enumerate(tail_ids) if x is None]
        unkept, unsafe = (np.zeros((2, len(words)), dtype=bool))
        unkept[lost] = True
        unsafe[[n for n in lost if not self.safe(words[n])]] = True
        ended = np.ones(len(tails), dtype=bool)
        ended[loose] = False
        unkept, unsafe = unkept[head] | ~ended[tail], unsafe[head] | ~ended[tail]
        bad = unsafe[place] | (rest & unkept[place])
        single = np.logical_or.reduceat(bad, starts) if len(bad) else np.zeros(0, dtype=bool)
        special = np.zeros(len(texts), dtype=bool)
        for s in self.special:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        both = (pa.array(ids, pa.large_binary()).take(pa.array(at)) for ids, at in ((word_ids, head), (tail_ids, tail)))
        joined = pc.binary_join_element_wise(*both, pa.scalar(b"", pa.large_binary())).take(pa.array(place[rest]))
        ends = np.concatenate(([0], np.cumsum(pc.binary_length(joined).fill_null(0).to_numpy())))
        data = joined.buffers()[2].to_pybytes() if int(ends[-1]) else b""
        begin = np.concatenate((starts, [len(place)])) - np.arange(len(texts) + 1)  # pieces with a space before each text
        cut = ends[begin].tolist()
        plain = np.flatnonzero(~single & ~special).tolist()
        out: list[bytes] = [b""] * len(texts)
        for i, first in zip(plain, self.whole(values.take(pa.array(place[starts[plain]])).to_pylist())):
            out[i] = first.tobytes() + data[cut[i] : cut[i + 1]]
        for chosen, make in ((single & ~special, self.pieced), (special, lambda some: [x.tobytes() for x in self.whole(some)])):
            spots = [i for i in np.flatnonzero(chosen).tolist() if texts[i].as_py()]
            for i, x in zip(spots, make([texts[i].as_py() for i in spots])):
                out[i] = x
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for all tasks of a worker, with the pieces it has met."""
    return Encoder(path)


def _files(own: DataFrame) -> int:
    """As many files as the estimated size asks for, if Spark has an estimate, and as the session shuffles to at least."""
    size = int(str(own._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES) if size < UNKNOWN else 1)


def write(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> None:
    """Writes the ids of every whole text, with end_id after each, in ascending order of the documents' ids to a new folder; path: the tokenizer's file.

    Documents are dealt out to files by ranges of their ids and sorted there, so one shuffle of texts is all; ids are encoded as they are made,
    FRAME_IDS at a time. A frame is a row of a Parquet file: part and frame say its place, `first` how many ids of the part come before it, doc_ids and lengths
    which documents it holds, payload is what rans.encode gives. A lost task is run again and its file committed once, as with all
    files that Spark writes.

    A null or empty text has the end id alone. Null ids come first, rows of one id stay all, ordered by a hash of their texts. An
    empty table gives a folder without rows. Strings of special tokens in a text become those tokens, as in the library. Other columns are not read.
    """
    kind = id_type(docs, id_col)
    own = two_columns(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"), "text")
    order = ["doc_id", "hash", "row"]  # the last one divides any number of equal rows
    dealt = own.repartitionByRange(_files(own), *order).sortWithinPartitions(*order).select("doc_id", "text")
    fields = [("part", T.IntegerType()), ("frame", T.IntegerType()), ("first", T.LongType()), ("ids", T.LongType()), ("doc_ids", T.ArrayType(kind)), ("lengths", T.ArrayType(T.LongType())), ("payload", T.BinaryType())]
    schema = T.StructType([T.StructField(name, k) for name, k in fields])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, tokens, part = to_arrow_schema(schema), encoder(path), TaskContext.get().partitionId()
        held, size, frame, first = [], 0, 0, 0

        def made() -> pa.RecordBatch:
            lengths = [len(x) // 4 for _, texts in held for x in texts]
            owners = pa.concat_arrays([d for d, _ in held])
            payload = rans.encode(np.frombuffer(b"".join([x for _, texts in held for x in texts]), "<u4"))
            columns = [[part], [frame], [first], [sum(lengths)], pa.ListArray.from_arrays(pa.array([0, len(owners)], pa.int32()), owners), [lengths], [payload]]
            return pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c, f.type)).cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for batch in batches:
            for piece in sliced(batch, 1, CHUNK_BYTES):
                texts = [ids + end for ids in tokens.encode(piece.column(1))]
                owners, at = piece.column(0), 0
                for i in range(len(texts) + 1):
                    if i == len(texts) or (size and size + len(texts[i]) > 4 * FRAME_IDS):
                        if i > at:
                            held.append((owners.slice(at, i - at), texts[at:i]))
                            at = i
                        if i < len(texts):
                            yield made()
                            first, frame = first + size // 4, frame + 1
                            held, size = [], 0
                    if i < len(texts):
                        size += len(texts[i])
            release()
        if held:
            yield made()

    dealt.mapInArrow(run, schema).write.option("parquet.block.size", GROUP_BYTES).parquet(f"{folder}/frames")


def _frames(spark: SparkSession, folder: str) -> DataFrame:
    """The frames with `base`, the ids of all parts before."""
    frames = spark.read.parquet(f"{folder}/frames")
    bases, before = [], 0
    for part, n in sorted(frames.groupBy("part").agg(F.sum("ids")).collect()):  # a row for each file
        bases.append((part, before))
        before += n
    return frames.join(F.broadcast(spark.createDataFrame(bases, "part int, base long")), "part")


def _decoded(spark: SparkSession, folder: str, name: str, kind: T.DataType, value) -> DataFrame:
    """(doc_id, start, n_tokens, name): what value gives for the ids of each document."""
    frames = _frames(spark, folder).select("doc_ids", "lengths", (F.col("base") + F.col("first")).alias("at"), "payload")
    fields = [("doc_id", frames.schema["doc_ids"].dataType.elementType), ("start", T.LongType()), ("n_tokens", T.LongType()), (name, kind)]
    schema = T.StructType([T.StructField(n, k) for n, k in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                owners, lengths = one.column(0).flatten(), one.column(1).flatten().to_numpy()
                ids, ends = rans.Frame(one.column(3)[0].as_py()).ids(), np.cumsum(lengths)
                starts = ends - lengths
                values = pa.array([value(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], arrow.field(3).type)
                yield pa.RecordBatch.from_arrays([owners.cast(arrow.field(0).type), pa.array(starts + one.column(2)[0].as_py()), pa.array(lengths), values], schema=arrow)
            release()

    return frames.mapInArrow(run, schema)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids array<long>) of what write() has written: start counts the ids of all documents before."""
    return _decoded(spark, folder, "ids", T.ArrayType(T.LongType()), lambda ids: ids.astype(np.int64))


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): as read(), with the CRC-32 of the ids as little-endian u32 in place of them."""
    return _decoded(spark, folder, "ids_crc32", T.LongType(), zlib.crc32)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """checksums() of docs, written to and read back from a folder beside the checkpoints, which is deleted at the end."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write(docs, path, folder)
    found = cut(checksums(spark, folder))
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return found
