"""SimHash near-duplicates: fingerprints, links within a Hamming radius, and their components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.components import components, keep_one
from lamina.llm.store import cut, small_or_not
from lamina.llm.words import id_type, map_texts

BITS = 64
SEED = 42
#: Shingles of one text whose bits are counted at a time.
BLOCK = 1 << 15
#: Fingerprints by which the pairs under a key are estimated.
SAMPLE = 2048


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of each run of width words, or of all words if they are fewer; none for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes.lower and bytes.split know ASCII only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    spaces = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    start = [0, *(spaces[: len(words) - width] + 1).tolist()]
    end = [*spaces[width - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(start, end)], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key long, fp long) for every row. A null or empty text has fingerprint 0.

    text_key is what xxhash64() gives for the text; it tells rows with one id apart.
    """

    def make():
        def f(ids: pa.Array, texts: pa.Array) -> list:
            rows = texts.to_pylist()
            keys = [SEED if t is None else xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), SEED) for t in rows]
            prints = [fingerprint(shingle_hashes(t, width)) for t in rows]
            return [ids, *(pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (keys, prints))]

        return f

    return map_texts(docs, [("doc_id", id_type(docs, id_col)), ("text_key", T.LongType()), ("fp", T.LongType())], make, id_col, text_col)


@dataclass(frozen=True)
class Plan:
    """Groups of bits and the distance up to which each group is probed; -1: the group is left out."""

    groups: tuple[tuple[int, ...], ...]
    radii: tuple[int, ...]

    @property
    def masks(self) -> list[int]:
        return [sum(1 << b for b in g) for g in self.groups]


def probes(bits: int, radius: int) -> int:
    """Keys within a distance of one key."""
    from math import comb

    return sum(comb(bits, j) for j in range(radius + 1))


def correlated_groups(together: np.ndarray, rows: int, count: int) -> tuple[tuple[int, ...], ...]:
    """Groups of bits of like size; a bit goes to the group with whose bits it correlates most.

    together: for each pair of bits, the rows in which both are 1.
    """
    p = np.diag(together) / max(rows, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    strength = np.abs((together / max(rows, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(strength, 0)
    size, left, groups = -(-BITS // count), set(range(BITS)), []
    while left:
        first = max(sorted(left), key=lambda b: strength[b, sorted(left)].sum())
        group = [first]
        left.remove(first)
        target = size if len(groups) < BITS % count or BITS % count == 0 else BITS // count
        while left and len(group) < target:
            best = max(sorted(left), key=lambda b: strength[b, group].mean())
            group.append(best)
            left.remove(best)
        groups.append(tuple(sorted(group)))
    return tuple(groups)


def near_chance(p: np.ndarray, radius: int) -> np.ndarray:
    """For two random rows, the chance that so many bits or fewer differ, of independent bits that are 1 with chance p."""
    differ, row = 2 * p * (1 - p), np.array([1.0])
    for d in differ:
        row = np.convolve(row, [1 - d, d])[: radius + 1]
    return np.cumsum(row)


def seen_chance(sample: np.ndarray, mask: int, radius: int) -> np.ndarray:
    """The share of pairs of sampled fingerprints of which so many bits or fewer differ under a mask: bits as they go together."""
    near, pairs = np.zeros(radius + 1), 0
    for at in range(0, len(sample), 512):
        part = np.bitwise_count((sample[at : at + 512, None] ^ sample[None, :]) & np.uint64(mask))
        part = part[np.arange(at, at + len(part))[:, None] < np.arange(len(sample))[None, :]]
        near += np.bincount(np.minimum(part, radius + 1), minlength=radius + 2)[: radius + 1]
        pairs += len(part)
    return np.cumsum(near) / max(pairs, 1)


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, tuple[int, ...]]:
    """The thresholds of least summed cost whose sum is total, by dynamic programming over the groups."""
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for cost in costs:
        after: dict[int, tuple[float, tuple[int, ...]]] = {}
        for spent, (c, picked) in best.items():
            for t, x in cost.items():
                if spent + t not in after or c + x < after[spent + t][0]:
                    after[spent + t] = (c + x, (*picked, t))
        best = after
    return best[total]


def plan_for(together: np.ndarray, rows: int, radius: int, probe_cost: float = 1.0, pair_cost: float = 0.01, sample: np.ndarray | None = None) -> Plan:
    """The groups and thresholds of least estimated work: keys written plus pairs met under a key.

    Pairs are estimated from those of a sample of fingerprints, for correlated bits agree more often than independent ones,
    and are at least what independent bits would give. Estimates decide on work only, never on what is found.

    By the general pigeonhole principle, thresholds of m groups that sum to radius - m + 1 lose no pair within radius:
    were every group's distance above its threshold, the distances would sum to at least radius + 1.
    """
    p, best = np.diag(together) / max(rows, 1), None
    for count in range(2, radius + 2):
        groups = correlated_groups(together, rows, count)
        costs = []
        for g in groups:
            chance = near_chance(p[list(g)], radius)
            if sample is not None and len(sample) > 1:
                chance = np.maximum(chance, seen_chance(sample, sum(1 << b for b in g), radius))
            costs.append({-1: 0.0} | {t: probe_cost * rows * probes(len(g), t) + pair_cost * rows * rows * chance[t] for t in range(radius + 1)})
        cost, radii = allocate(costs, radius - count + 1)
        if best is None or cost < best[0]:
            best = (cost, Plan(groups, radii))
    return best[1]


def bit_counts(prints: DataFrame) -> tuple[np.ndarray, int]:
    """For each pair of bits, the rows in which both are 1; and the rows. Each task sends one sum for each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fp), BLOCK):
                x = np.unpackbits(np.ascontiguousarray(fp[at : at + BLOCK]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += x.T @ x
                rows += len(x)
        i, j = np.triu_indices(BITS)
        keys = np.append(i * BITS + j, -1)
        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(np.append(total[i, j], rows).astype(np.int64))], names=["pair", "n"])

    sums = {r[0]: r[1] for r in prints.select("fp").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()}
    together = np.zeros((BITS, BITS))
    for pair, n in sums.items():
        if pair >= 0:
            together[pair // BITS, pair % BITS] = together[pair % BITS, pair // BITS] = n
    return together, int(sums.get(-1, 0))


@lru_cache(maxsize=64)
def flips(mask: int, radius: int) -> np.ndarray:
    """What to xor a key with, for every key within radius under the mask."""
    bits = [b for b in range(BITS) if mask >> b & 1]
    return np.array([sum(1 << b for b in chosen) for n in range(radius + 1) for chosen in combinations(bits, n)], dtype=np.uint64)


def _divided(plan: Plan, part: int, radius: int) -> list[int]:
    """Masks of radius + 1 blocks of the bits outside a group: one of them is equal for any pair within radius."""
    free = [b for b in range(BITS) if not plan.masks[part] >> b & 1]
    return [sum(1 << b for b in free[k :: radius + 1]) for k in range(radius + 1)]


def _keys(plan: Plan, radius: int, crowded: Broadcast | None):
    """Each fingerprint under every key of its groups: its own and those within the group's threshold.

    The part tells the group; of a crowded key, given as {group: keys in order}, it tells the block, too, and the key has that
    block's bits as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = crowded.value if crowded else {}

        def rows(part: int, keys: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), part, dtype=np.int16)), pa.array(keys.view(np.int64)), pa.array(fp.view(np.int64))], names=["part", "key", "fp"])

        for batch in batches:
            all_fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(all_fp), 4096):
                some = all_fp[at : at + 4096]
                for i, (mask, near) in enumerate(zip(plan.masks, plan.radii)):
                    if near < 0:
                        continue
                    change = flips(mask, near)
                    keys, fp = ((some & np.uint64(mask))[:, None] ^ change[None, :]).ravel(), np.repeat(some, len(change))
                    if len(own := full.get(i, ())):
                        most = np.isin(keys, own)
                        for k, block in enumerate(_divided(plan, i, radius)):
                            yield rows(i + len(plan.masks) * (k + 1), keys[most] | fp[most] & np.uint64(block), fp[most])
                        keys, fp = keys[~most], fp[~most]
                    yield rows(i, keys, fp)

    return run


#: Fingerprints with one key of their own above which the key is divided among tasks.
CROWD_ROWS = 65_536


def crowded_keys(distinct: DataFrame, plan: Plan, rows: int, most: int) -> dict[int, np.ndarray]:
    """The keys, by group, that more than `most` fingerprints have as their own; at most a row for each `most` of them."""
    if rows <= most:
        return {}
    own = [F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(int(np.uint64(m).view(np.int64)))).alias("key")) for i, (m, r) in enumerate(zip(plan.masks, plan.radii)) if r >= 0]
    counted = distinct.select(F.explode(F.array(*own)).alias("own")).groupBy("own.part", "own.key").count().filter(F.col("count") > most)
    out: dict[int, list[int]] = {}
    for part, key, _ in counted.collect():
        out.setdefault(part, []).append(key)
    return {part: np.sort(np.array(keys, dtype=np.int64).view(np.uint64)) for part, keys in out.items()}


#: Fingerprints under one key above which the key's group is divided by its other bits, too.
CROWD = 2048


def _walk(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint is compared only with those not yet reached, so a dense group costs little; each edge is a link."""
    left, a, b = fp, [], []
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            here = queue.pop()
            near = np.bitwise_count(left ^ here) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                a.append(np.full(len(found), here))
                b.append(found)
                queue.extend(found)
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def local_edges(fp: np.ndarray, radius: int, mask: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect just the fingerprints that pairs within radius connect; mask: bits known to be equal.

    A small group is compared at once. A large one is divided by radius + 1 blocks of its other bits, of which one is
    equal for any pair within radius.
    """
    fp = np.unique(fp)
    if len(fp) <= 256:
        i, j = np.nonzero(np.triu(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius, 1))
        return (fp[i], fp[j]) if len(i) <= 4 * len(fp) else _walk(fp, radius)
    if len(fp) <= CROWD:
        return _walk(fp, radius)
    free, found = [b for b in range(BITS) if not mask >> b & 1], []
    for k in range(radius + 1):
        keys = fp & np.uint64(sum(1 << b for b in free[k :: radius + 1]))
        order = np.argsort(keys, kind="stable")
        found += [_walk(fp[part], radius) for part in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1) if len(part) > 1]
    return (np.concatenate([e[0] for e in found]), np.concatenate([e[1] for e in found])) if found else (fp[:0], fp[:0])


def _met_edges(fp: np.ndarray, own: np.ndarray, radius: int, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges among fingerprints under one key: those whose key it is with each other, and with those that probe it."""
    if len(fp) > CROWD or own.all():
        return local_edges(fp, radius, mask)
    index, probes_ = np.unique(fp[own]), np.unique(fp[~own])
    a, b = local_edges(index, radius, mask)
    i, j = np.nonzero(np.bitwise_count(index[:, None] ^ probes_[None, :]) <= radius)
    if len(i) > 4 * len(fp):
        return _walk(np.unique(fp), radius)
    return np.concatenate([a, index[i]]), np.concatenate([b, probes_[j]])


def _group_edges(plan: Plan, radius: int):
    """Edges of each run of rows with one key; rows come ordered by group and key."""
    groups = len(plan.masks)
    bits = np.array([*plan.masks, *(0 for _ in range(groups * (radius + 1)))], dtype=np.uint64)  # of the group's own key
    known = [m if r == 0 else 0 for m, r in zip(plan.masks, plan.radii)] + [0] * (groups * (radius + 1))  # bits equal in a run
    for i in range(groups):
        for k, block in enumerate(_divided(plan, i, radius)):
            bits[i + groups * (k + 1)] = plan.masks[i]
            known[i + groups * (k + 1)] = block | known[i]

    def edges(part: np.ndarray, key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(key):
            return
        start = np.concatenate(([0], np.flatnonzero((np.diff(key) != 0) | (np.diff(part) != 0)) + 1))
        size = np.diff(np.append(start, len(key)))
        mine = (fp & bits[part]) == key.view(np.uint64) & bits[part]
        own = np.logical_or.reduceat(mine, start)  # else only probes meet here
        pairs = start[(size == 2) & own]
        near = np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= radius
        a, b = [fp[pairs][near]], [fp[pairs + 1][near]]
        for s, n in zip(start[(size > 2) & own].tolist(), size[(size > 2) & own].tolist()):
            x, y = _met_edges(fp[s : s + n], mine[s : s + n], radius, known[part[s]])
            a.append(x)
            b.append(y)
        x, y = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        if len(x):
            found = np.unique(np.stack([np.maximum(x, y), np.minimum(x, y)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            part, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(key):
                continue
            fp = fp.view(np.uint64)
            last = np.flatnonzero((key != key[-1]) | (part != part[-1]))
            tail = int(last[-1]) + 1 if len(last) else 0
            if not tail and held and held[-1][0][-1] == part[0] and held[-1][1][-1] == key[0]:
                held.append((part, key, fp))
                continue
            yield from edges(*(np.concatenate(x) for x in zip(*held, (part[:tail], key[:tail], fp[:tail]))))
            held = [(part[tail:], key[tail:], fp[tail:])]
        if held:
            yield from edges(*(np.concatenate(x) for x in zip(*held)))

    return run


def link_edges(distinct: DataFrame, radius: int = 4) -> tuple[DataFrame, Plan]:
    """Edges (a, b) among distinct fingerprints that connect whatever pairs within radius connect, and the plan used.

    A fingerprint is written once under its own key of each group and once under each key that it probes; only the own ones
    are compared with the rest. Keys that very many fingerprints have are divided by blocks of their other bits.
    """
    together, rows = bit_counts(distinct)
    some = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toArrow().column(0).to_numpy().view(np.uint64)
    plan = plan_for(together, rows, radius, sample=some)
    full = crowded_keys(distinct, plan, rows, CROWD_ROWS)
    shared = distinct.sparkSession.sparkContext.broadcast(full) if full else None  # at most rows / CROWD_ROWS keys a group
    keyed = distinct.select("fp").mapInArrow(_keys(plan, radius, shared), "part short, key long, fp long")
    ordered = keyed.repartition("part", "key").sortWithinPartitions("part", "key")
    return ordered.mapInArrow(_group_edges(plan, radius), "a long, b long"), plan


def _grouped(docs: DataFrame, radius: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, fp, component_id, root) for every row; root is the same for all rows of a component."""
    prints = cut(fingerprints(docs, width, id_col, text_col))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    edges, _ = link_edges(distinct, radius)
    roots = cut(components(edges).withColumnRenamed("node", "fp"))
    least = distinct.join(small_or_not(roots), "fp").groupBy("root").agg(F.min("first_id").alias("least_id"))
    linked = cut(roots.join(least, "root").select("fp", "root", "least_id"))
    named = distinct.join(small_or_not(linked), "fp", "left").select("fp", F.coalesce("least_id", "first_id").alias("component_id"), F.coalesce("root", "fp").alias("root"))
    return prints.join(small_or_not(cut(named)), "fp")


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs.

    fingerprint: 16 lowercase hex digits. component_id: the smallest doc_id reachable over links of at most radius
    differing bits, the row's own included. Equal fingerprints meet once, as one node, so copies cost one row each.
    Null and empty texts have fingerprint zero and are linked like any other; rows with a null id join components but
    give them no id (component_id is null if no row has one); repeated rows stay; an empty table gives no rows.
    """
    found = _grouped(docs, radius, width, id_col, text_col)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, radius: int = 4, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component, with all their columns: that of the smallest id, see keep_one.

    Rows with a null id come after all others; of repeated rows of one id and text one stays.
    """
    found = _grouped(docs, radius, width, id_col, text_col)
    return keep_one(docs, cut(found.select("doc_id", "text_key", F.col("root").alias("grp"))), id_col, text_col)
