"""Near-duplicates by similarity of word shingles: SimHash links first, then nearest fingerprints under rare shingles.

The weighted similarity of two texts is that of decontaminate.weighted_similarity: shingles that both have, over those
that either has, each counted as often as it occurs. Texts are linked only if that is at least what is asked.

1. Fingerprints of the shingles meet by the general pigeonhole plan of simhash.link_edges, and each link is verified.
2. In one order of all shingles, the first n - ceil(similarity * n) + 1 of n shingles of one text and those of the other have one
   in common. So every similar pair meets under some shingle of its prefixes; and under the first that it shares, the texts can have
   no more in common than what either has from there on, which has to be enough for the similarity (the positional filter of
   PPJoin, Xiao and others, 2008). Rare shingles come first, so texts of one template that differ in too many places never pair
   under the template's shingles. Texts of different components are verified there
   with those whose fingerprints are nearest, all of FEW or the NEAREST under each shingle, in rounds, until one joins hardly any.
3. Then all pairs of different components that meet so, within NEAR_RADIUS bits, are verified. There each text brings a sketch: for
   each of SKETCH classes of shingles whether it has an odd number of them. A shingle that one of two texts has alone changes one class, so
   two sketches differ in no more classes than there are such shingles, and pairs that differ in too many for the similarity are left out
   without their texts. Nothing is capped: two texts are
   linked if their fingerprints are within NEAR_RADIUS and the similarity is reached. The rounds only leave few components,
   for texts of one component are not compared again.

A similar pair meets under nearly all of its prefixes' shingles, but once is enough. Of shingles that the same texts have, the first in the
order alone is kept: all their pairs meet there, with the least places. In the exact pass each text also brings the BEFORE shingles that its
prefix has before this one: two texts that share one of them meet under that, too, and are no pair here. The first shingle that two texts
share is never left out by either rule, so each pair is still written there. In the rounds, where under a shingle of many texts only the nearest
meet, the second rule would leave pairs to later rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.components import components, keep_one
from lamina.llm.decontaminate import SIMILARITY, WIDTH
from lamina.llm.simhash import SEED, fingerprint, link_edges, shingle_hashes
from lamina.llm.store import cut, shed, small_or_not
from lamina.llm.words import id_type, map_texts, mix, release

#: Texts whose shingles are counted for the order of shingles, and the most shingles that are told apart by their counts.
#: Any order gives the same pairs; rare shingles first makes few candidates of them.
SAMPLE, COMMON = 5_000, 200_000
#: Differing bits up to which fingerprints are linked before the prefixes; and up to which they are near under a shingle. Texts of
#: similarity 0.8 differ in about 10 of 64 bits on average; 22 is over four standard deviations more.
RADIUS, NEAR_RADIUS = 4, 22
#: Texts under one shingle up to which all pairs are verified, nearest fingerprints that are beyond, and texts that are compared at once.
FEW, NEAREST, CHUNK = 8, 3, 4096
#: Pairs that are compared at a time in the exact pass.
PAIRS = 1 << 20
#: Texts under one shingle that the exact pass compares in one group; more are divided into blocks, and each two blocks are a group.
BLOCK_ROWS = 20_000
#: Shingles before its own that each row under a shingle brings.
BEFORE = 4
#: Rows under one shingle up to which its texts are compared with those of other shingles.
WHOLE = 1 << 20
#: Classes of shingles in a sketch, a power of two: of texts of fewer shingles than that nearly all pairs are told apart without their texts.
SKETCH = 1024
#: Pairs whose sketches are compared at a time.
SKETCHES = 1 << 16
#: A round that joins a smaller share of all that were joined is the last.
GAIN = 0.02
#: Bytes of bags up to which they are broadcast to the pairs that are verified.
BAG_BYTES = 16 << 20
#: Share of a sample's texts from which a shingle is dealt to many tasks.
HEAVY = 0.01
#: Against rounding of products of similarity and sizes; it only adds candidates.
_SLACK = 1e-9


def bag(text: str | None, width: int = WIDTH) -> np.ndarray:
    return bag_of(shingle_hashes(text, width))


def bag_of(hashes: np.ndarray) -> np.ndarray:
    """The shingles' hashes in order, the second and further ones of equal shingles changed by their number: a set."""
    h = np.sort(hashes)
    if len(h) > 1:
        at = np.arange(len(h))
        again = at - np.maximum.accumulate(np.where(np.diff(h, prepend=~h[:1]) != 0, at, 0))
        h = np.sort(np.where(again > 0, mix(h ^ mix(again.astype(np.uint64))), h))
    return h


def prefix(own: np.ndarray, common: np.ndarray, counts: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The first of a bag's hashes in the order of counts and then hashes, as many as the similarity asks; and their counts."""
    take = len(own) - ceil(similarity * len(own) - _SLACK) + 1 if len(own) else 0
    often = np.zeros(len(own), dtype=np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        often = np.where(common[at] == own, counts[at], 0)
    first = np.argsort(often, kind="stable")[:take]
    return own[first], often[first]


def sketch(own: np.ndarray) -> np.ndarray:
    """For each class of a bag's hashes whether it has an odd number of them, as bits."""
    odd = np.bincount((own & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8))


def sketches_near(marks: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Whether bags i and j of n hashes can have the similarity by their sketches, given as rows of words: whether they differ in no more
    classes than the bags may in hashes."""
    spare = (1 - similarity) / (1 + similarity) * (n[i] + n[j]) + _SLACK
    out = np.empty(len(i), dtype=bool)
    for at in range(0, len(i), SKETCHES):
        some = slice(at, at + SKETCHES)
        out[some] = np.bitwise_count(marks[i[some]] ^ marks[j[some]]).sum(axis=1, dtype=np.int64) <= spare[some]
    return out


def common_shingles(docs: DataFrame, width: int, id_col: str, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in two or more texts of a sample, in order, and in how many."""

    def make():
        def f(ids: pa.Array, texts: pa.Array) -> list:
            return [np.concatenate([np.zeros(0, np.uint64), *(bag(t, width) for t in texts.to_pylist())]).view(np.int64)]

        return f

    some = docs.sample(min(1.0, SAMPLE / max(docs.count(), 1)), seed=SEED)
    counted = map_texts(some, [("token", T.LongType())], make, id_col, text_col).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    found = counted.filter("n > 1").orderBy(F.desc("n"), "token").limit(COMMON).toArrow()
    tokens = found.column(0).to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], found.column(1).to_numpy()[order]


def _prefixes(docs: DataFrame, similarity: float, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, bag long, fp long, n, prefix, heavy int, sketch) for every row; bag is equal for equal bags, n the shingles.

    The last `heavy` hashes of the prefix are in very many texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, width, id_col, text_col))  # of COMMON rows at most

    def make():
        common, counts = shared.value

        def f(ids: pa.Array, texts: pa.Array) -> list:
            rows = texts.to_pylist()
            shingles = [shingle_hashes(t, width) for t in rows]
            bags, prints = [bag_of(h) for h in shingles], [fingerprint(h) for h in shingles]
            keys = [SEED if t is None else xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), SEED) for t in rows]
            names = [xxhash.xxh64_intdigest(b.tobytes(), SEED) for b in bags]
            sizes = np.array([len(b) for b in bags], dtype=np.int64)
            found = [prefix(b, common, counts, similarity) for b in bags]
            firsts = pa.array([p.tobytes() for p, _ in found], pa.binary())
            heavy = np.array([(c >= max(2, HEAVY * SAMPLE)).sum() for _, c in found], dtype=np.int32)
            marks = pa.array([sketch(b).tobytes() for b in bags], pa.binary())
            return [ids, *(pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (keys, names, prints)), sizes, firsts, heavy, marks]

        return f

    fields = [("doc_id", id_type(docs, id_col)), ("text_key", T.LongType()), ("bag", T.LongType()), ("fp", T.LongType()), ("n", T.LongType()), ("prefix", T.BinaryType()), ("heavy", T.IntegerType()), ("sketch", T.BinaryType())]
    return map_texts(docs, fields, make, id_col, text_col)


def able(n: np.ndarray, place: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Whether bags i and j of n hashes can have the similarity if the hash at these places of theirs is the first that they share."""
    needed = similarity / (1 + similarity) * (n[i] + n[j]) - _SLACK
    return np.minimum(n[i] - place[i], n[j] - place[j]) >= needed


def earlier(before: list[np.ndarray], rows: int) -> np.ndarray:
    """For each row the hashes that its prefix has before the row's, the nearest first. before: their bytes, the nearest last, or nothing."""
    return np.frombuffer(b"".join(before[0]), dtype=np.int64).reshape(rows, BEFORE)[:, ::-1] if before else np.zeros((rows, 0), np.int64)


def met(known: np.ndarray, place: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j under one hash share one of the hashes known to be before it; at place k a prefix has only k of them."""
    out = np.zeros(len(i), dtype=bool)
    for a in range(known.shape[1]):
        for b in range(known.shape[1]):
            out |= (known[i, a] == known[j, b]) & (place[i] > a) & (place[j] > b)
    return out


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each bag under every hash of its prefix, with its place there, and whether very many texts have the hash."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            firsts = [np.frombuffer(p, dtype=np.int64) for p in part.column(1).to_pylist()]
            each = np.array([len(p) for p in firsts])
            place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            heavy = place >= np.repeat(each - part.column(2).to_numpy(zero_copy_only=False), each)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(firsts)), pa.array(np.repeat(part.column(0).to_numpy(zero_copy_only=False), each)), pa.array(place.astype(np.int32)), pa.array(heavy)], names=["token", "bag", "place", "heavy"])


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of ordered rows in pieces that begin and end with a run of one first column, or divide a run of over most rows."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        rows = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(rows[0]):
            continue
        held.append(rows)
        tail = int(np.searchsorted(rows[0], rows[0][-1])) if (rows[0][0] != rows[0][-1]) else 0
        if tail:
            yield tuple(np.concatenate(x) for x in zip(*held[:-1], tuple(r[:tail] for r in rows)))
            held = [tuple(r[tail:] for r in rows)]
        elif len(held) > 1 and held[-2][0][-1] != rows[0][0]:
            yield tuple(np.concatenate(x) for x in zip(*held[:-1]))
            held = [rows]
        elif sum(len(h[0]) for h in held) >= most:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held = []
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of hashes that two bags or more have, with two numbers that are equal for hashes of the same bags, and the sum of the hash's
    places: of such hashes it is least for the first. Rows come ordered by hash; hashes of divided runs get numbers of their own."""
    divided = None
    for token, bags, place in _runs(batches, WHOLE):
        start = np.flatnonzero(np.diff(token, prepend=~token[:1]) != 0)
        size = np.diff(np.append(start, len(token)))
        alone = (token[start] == divided) | (len(token) >= WHOLE)
        divided = token[-1] if len(token) >= WHOLE else None
        names, own = bags.view(np.uint64), token[start].view(np.uint64)
        same = [np.where(alone, mix(own, tag), np.bitwise_xor.reduceat(mix(names, tag), start)).view(np.int64) for tag in (1, 2)]
        rest = [np.repeat(x, size) for x in (*same, np.add.reduceat(place.astype(np.int64), start))]
        keep = np.repeat((size > 1) | alone, size)
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (token, bags, place, *rest)], names=["token", "bag", "place", "same", "also", "places"])


def _first_of_same(shared: DataFrame) -> DataFrame:
    """Rows of _shared without those of hashes whose bags are those of an earlier hash."""
    first = shared.groupBy("same", "also").agg(F.min(F.struct("places", "token")).alias("first")).select("first.token").distinct()
    return shared.join(small_or_not(cut(first)), "token", "left_semi").drop("same", "also", "places")


def _nearest(similarity: float):
    """Pairs of bags of different components under one hash whose sizes allow the similarity: all of a few, else the nearest
    fingerprints. Rows come ordered by hash and a turned fingerprint, so that long runs are divided among alike ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, comp, names, n, fp, place in _runs(batches, 16 * CHUNK):
            fp, pairs = fp.view(np.uint64), []
            start = np.flatnonzero(np.diff(token, prepend=~token[:1]) != 0)
            size = np.diff(np.append(start, len(token)))
            left, apart = np.flatnonzero(np.repeat(size <= FEW, size)), 1
            while len(left):  # each row with the one so many places on
                left = left[left + apart < len(token)]
                left = left[token[left] == token[left + apart]]
                pairs.append((left, left + apart))
                apart += 1
            for s, c in zip(start[size > FEW].tolist(), size[size > FEW].tolist()):
                for at in np.array_split(np.arange(s, s + c), -(-c // CHUNK)):
                    for some in np.array_split(at, -(-len(at) // 256)):
                        away = np.bitwise_count(fp[some][:, None] ^ fp[at][None, :]).astype(np.int16)
                        low, high = np.minimum(n[some][:, None], n[at][None, :]), np.maximum(n[some][:, None], n[at][None, :])
                        away[(comp[some][:, None] == comp[at][None, :]) | (low < similarity * high - _SLACK) | ~able(n, place, some[:, None], at[None, :], similarity)] = 99
                        near = np.argpartition(away, NEAREST, axis=1)[:, :NEAREST] if len(at) > NEAREST else np.tile(np.arange(len(at)), (len(some), 1))
                        i, j = np.repeat(np.arange(len(some)), near.shape[1]), near.ravel()
                        fit = away[i, j] <= NEAR_RADIUS
                        pairs.append((some[i[fit]], at[j[fit]]))
            i, j = (np.concatenate([p[k] for p in pairs]) for k in (0, 1)) if pairs else (np.zeros(0, np.int64),) * 2
            fit = (comp[i] != comp[j]) & able(n, place, i, j, similarity) & (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - _SLACK) & (np.bitwise_count(fp[i] ^ fp[j]) <= NEAR_RADIUS)
            i, j = i[fit], j[fit]
            if len(i):
                turn = names[i] < names[j]
                i, j = np.where(turn, j, i), np.where(turn, i, j)
                found = np.unique(np.stack([names[i], names[j], comp[i], comp[j]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[:, k])) for k in range(4)], names=["a", "b", "comp_a", "comp_b"])

    return run


def _rest(similarity: float):
    """All pairs of bags of different components under one hash within NEAR_RADIUS whose sizes and sketches allow the similarity.

    Rows come ordered by hash and component; of each hash all are there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, comp, names, n, fp, place, marks, *before in _runs(batches, 1 << 62):
            fp, known = fp.view(np.uint64), earlier(before, len(token))
            marks = np.frombuffer(b"".join(marks), dtype=np.uint64).reshape(len(marks), -1)
            start = np.flatnonzero(np.diff(token, prepend=~token[:1]) != 0)
            size = np.diff(np.append(start, len(token)))
            for s, c in zip(start.tolist(), size.tolist()):
                at = np.arange(s, s + c)
                runs = sorted(np.split(at, np.flatnonzero(np.diff(comp[at])) + 1), key=len)
                order, done = np.concatenate(runs), 0
                for own in runs[:-1]:  # each row of the smaller components with all of the larger
                    done += len(own)
                    others = order[done:]
                    for some in np.array_split(own, -(-len(own) * len(others) // PAIRS)):
                        low, high = np.minimum(n[some][:, None], n[others][None, :]), np.maximum(n[some][:, None], n[others][None, :])
                        i, j = np.nonzero((np.bitwise_count(fp[some][:, None] ^ fp[others][None, :]) <= NEAR_RADIUS) & (low >= similarity * high - _SLACK) & able(n, place, some[:, None], others[None, :], similarity))
                        i, j = some[i], others[j]
                        new = ~met(known, place, i, j)
                        i, j = i[new], j[new]
                        fit = sketches_near(marks, n, i, j, similarity)
                        if fit.any():
                            x, y = i[fit], j[fit]
                            turn = names[x] < names[y]
                            x, y = np.where(turn, y, x), np.where(turn, x, y)
                            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (names[x], names[y], comp[x], comp[y])], names=["a", "b", "comp_a", "comp_b"])

    return run


def _bags(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(bag, hashes) for every row."""

    def make():
        def f(ids: pa.Array, texts: pa.Array) -> list:
            bags = [bag(t, width) for t in texts.to_pylist()]
            names = np.array([xxhash.xxh64_intdigest(b.tobytes(), SEED) for b in bags], dtype=np.uint64).view(np.int64)
            return [names, pa.array([b.view(np.int64) for b in bags], pa.list_(pa.int64()))]

        return f

    return map_texts(docs, [("bag", T.LongType()), ("hashes", T.ArrayType(T.LongType()))], make, id_col, text_col)


def verified(docs: DataFrame, distinct: DataFrame, pairs: DataFrame, similarity: float, width: int, id_col: str, text_col: str) -> DataFrame:
    """Those of some pairs (a, b) of bags that have at least the similarity. Only texts of bags in a pair are read anew."""
    wanted = pairs.select(F.col("a").alias("bag")).union(pairs.select("b")).distinct()
    keys = small_or_not(cut(distinct.join(wanted, "bag").select("first.doc_id", "first.text_key")))
    same = docs[id_col].eqNullSafe(keys["doc_id"]) & (F.xxhash64(docs[text_col].cast("string")) == keys["text_key"])
    bags = cut(_bags(docs.join(keys, same, "left_semi"), width, id_col, text_col).groupBy("bag").agg(F.first("hashes").alias("hashes")))
    bags = small_or_not(bags, size=BAG_BYTES)  # else each pair's bags move to it
    both = pairs.join(bags.toDF("a", "x"), "a").join(bags.toDF("b", "y"), "b")
    sizes = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("both"), (F.size("x") + F.size("y")).alias("sizes"))
    return cut(sizes.filter(F.col("both") / (F.col("sizes") - F.col("both")) >= similarity).select("a", "b"))


def fingerprint_pairs(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): bags that links of their fingerprints connect. Of bags with one fingerprint, all pair with the first."""
    heads = cut(distinct.groupBy("fp").agg(F.min("bag").alias("head")))
    alike = distinct.join(heads, "fp").filter("bag <> head").select(F.col("bag").alias("a"), F.col("head").alias("b"))
    edges = link_edges(heads, radius)[0].distinct().join(heads.toDF("a", "x"), "a").join(heads.toDF("b", "y"), "b")
    return cut(alike.unionByName(edges.select(F.col("x").alias("a"), F.col("y").alias("b"))))


def _components_of(bags: DataFrame, roots: DataFrame) -> DataFrame:
    """bags with comp: the root of each bag, or itself."""
    return bags.join(small_or_not(roots.withColumnRenamed("node", "bag")), "bag", "left").withColumn("comp", F.coalesce("root", "bag")).drop("root")


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) of the components that links (comp_a, comp_b) make of those there are."""
    new = small_or_not(cut(components(links.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))).toDF("old", "new")))
    moved = roots.join(new, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
    alone = new.select(F.col("old").alias("node"), F.col("new").alias("root")).join(roots.select("node"), "node", "left_anti")
    return cut(moved.unionByName(alone))


def _apart(placed: DataFrame) -> DataFrame:
    """Rows under a hash that texts of two components or more have."""
    several = placed.groupBy("token").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).filter("least < most").select("token")
    return placed.join(small_or_not(cut(several)), "token", "left_semi")


def _divided(placed: DataFrame) -> DataFrame:
    """Rows under a hash; those of very many rows in blocks, each two of which are a group of their own, under another hash."""
    parts = F.ceil(F.col("count") / (BLOCK_ROWS / 2)).cast("int").alias("parts")
    crowded = cut(placed.groupBy("token").count().filter(F.col("count") > BLOCK_ROWS).select("token", parts))
    if crowded.isEmpty():
        return placed
    crowded = small_or_not(crowded)
    rows = placed.join(crowded, "token").withColumn("one", F.pmod(F.xxhash64("bag"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    group = F.xxhash64("token", F.least("one", "other"), F.greatest("one", "other"))
    return placed.join(crowded, "token", "left_anti").unionByName(rows.withColumn("token", group).select(*placed.columns))


def grown(docs: DataFrame, distinct: DataFrame, roots: DataFrame, similarity: float, width: int, id_col: str, text_col: str) -> DataFrame:
    """(node, root) after rounds of verified pairs of different components under the hashes of their prefixes."""
    posted = distinct.select("bag", "prefix", "heavy").mapInArrow(_postings, "token long, bag long, place int, heavy boolean")
    light = posted.filter("NOT heavy").select("token", "bag", "place").repartition("token").sortWithinPartitions("token").mapInArrow(_shared, "token long, bag long, place int, same long, also long, places long")
    live = _first_of_same(cut(light)).withColumn("heavy", F.lit(False)).unionByName(posted.filter("heavy"))
    before = F.expr(f"lpad(substring(prefix, greatest(8 * (place - {BEFORE}), 0) + 1, 8 * least(place, {BEFORE})), {8 * BEFORE})").alias("before")
    live = cut(live.join(distinct.select("bag", "prefix"), "bag").select("token", "bag", "place", "heavy", before))
    sizes = cut(distinct.join(live.select("bag").distinct(), "bag", "left_semi").select("bag", "n", "fp"))
    tested, merges, turn, last = None, 0, 0, False
    while True:
        shed(docs.sparkSession)
        placed = live.join(small_or_not(cut(_components_of(sizes, roots))), "bag")
        if last:
            placed = _divided(cut(_apart(placed))).join(distinct.select("bag", "sketch"), "bag")
            ordered, meet = placed.repartition("token").sortWithinPartitions("token", "comp"), _rest(similarity)
        else:
            turned = F.expr(f"shiftleft(fp, {8 * turn % 64}) | shiftrightunsigned(fp, {64 - 8 * turn % 64})") if turn % 8 else F.col("fp")
            part = F.when(F.col("heavy"), F.shiftrightunsigned(turned, 54)).otherwise(0)
            ordered, meet = placed.withColumn("turned", turned).repartition("token", part).sortWithinPartitions("token", "turned"), _nearest(similarity)
        pairs = ordered.select("token", "comp", "bag", "n", "fp", "place", *(["sketch", "before"] if last else [])).mapInArrow(meet, "a long, b long, comp_a long, comp_b long").distinct()
        if tested is not None:
            pairs = pairs.join(small_or_not(tested), ["a", "b"], "left_anti")
        pairs, placed, ordered = cut(pairs), None, None
        links = cut(verified(docs, distinct, pairs.select("a", "b"), similarity, width, id_col, text_col).join(pairs, ["a", "b"]).select("comp_a", "comp_b").distinct())
        gained = links.count()
        roots = joined(roots, links) if gained else roots
        if last:
            return roots
        merges, turn, last = merges + gained, turn + 1, gained <= GAIN * (merges + gained)
        tested = cut(pairs.select("a", "b") if tested is None else tested.unionByName(pairs.select("a", "b")))


def _grouped(docs: DataFrame, similarity: float, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, grp) for every row; grp is the same for all rows of a component."""
    prints = cut(_prefixes(docs, similarity, width, id_col, text_col))
    first = F.min(F.struct("doc_id", "text_key")).alias("first")
    distinct = cut(prints.groupBy("bag").agg(first, F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("heavy").alias("heavy"), F.first("sketch").alias("sketch")))
    roots = cut(components(verified(docs, distinct, fingerprint_pairs(distinct), similarity, width, id_col, text_col)))
    roots = grown(docs, distinct, roots, similarity, width, id_col, text_col)
    release()
    return cut(_components_of(prints.select("doc_id", "text_key", "bag"), roots).select("doc_id", "text_key", F.col("comp").alias("grp")))


def keep_first(docs: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component of texts linked at the similarity, with all their columns: that of the smallest id.

    Equal bags, those without any word too, are one node. Rows with a null id come after all others; of repeated rows of one
    id and text one stays (see keep_one). An empty table gives an empty one.
    """
    return keep_one(docs, _grouped(docs, similarity, width, id_col, text_col), id_col, text_col)
