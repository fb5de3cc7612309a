"""Near-duplicates by similarity of five-word shingles against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from lamina.llm import neardup
from lamina.llm.decontaminate import weighted_similarity
from lamina.llm.simhash import shingle_hashes


def texts_of_all_similarities() -> list[str]:
    """Texts of many lengths, each with copies of which some words are changed, repeated or left out."""
    rng, out = random.Random(11), []
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    for size in (1, 3, 4, 5, 6, 8, 9, 20, 60, 200, 700):
        for _ in range(4):
            words = [word() for _ in range(size)]
            words += words[: size // 4] * rng.randint(0, 2)
            out.append(" ".join(words))
            for share in (0, 0.003, 0.01, 0.02, 0.03, 0.05):
                changed = [word() if rng.random() < share else w for w in words]
                out.append(" ".join(changed[: len(changed) - rng.randint(0, max(1, size // 20))]))
    return out


def expected(texts: list[str]) -> list[int]:
    bags = [np.sort(shingle_hashes(t, 5)) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and (np.array_equal(bags[i], bags[j]) or weighted_similarity(bags[i], bags[j]) >= 0.8):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return [i for i in range(len(texts)) if root[i] == i]


@pytest.mark.parametrize("common", [200_000, 3, 0])
def test_stage_equals_brute_force_at_similarity_of_80(spark, monkeypatch, common):
    monkeypatch.setattr(neardup, "COMMON", common)
    texts = texts_of_all_similarities()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    assert kept == expected(texts)


def test_bags_are_sets_of_the_same_similarity():
    for a, b in (("x " * 40, "x " * 44), ("a b c d e f " * 5, "a b c d e f " * 4 + "g"), ("one", "one"), ("one two", "two one")):
        x, y = neardup.bag(a), neardup.bag(b)
        assert len(np.unique(x)) == len(x)
        both = len(np.intersect1d(x, y))
        assert both / (len(x) + len(y) - both) == weighted_similarity(shingle_hashes(a, 5), shingle_hashes(b, 5))


def test_links_are_found_across_batches(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        texts = texts_of_all_similarities()[:140]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
        assert sorted(r.doc_id for r in neardup.keep_first(docs).collect()) == expected(texts)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def near_copies(rng: random.Random, size: int, group: int, share: float) -> list[str]:
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(size)]
    return [" ".join("".join(rng.choices("abcdefgh", k=4)) if rng.random() < share * rng.random() else w for w in words) for _ in range(group)]


@pytest.mark.parametrize("few", [8, 2])
def test_a_large_group_of_near_copies_loses_no_link(spark, monkeypatch, few):
    """Far more texts under a shingle than FEW: what the rounds leave is found by the exact pass after them."""
    monkeypatch.setattr(neardup, "FEW", few)
    rng = random.Random(5)
    texts = near_copies(rng, 120, 300, 0.06) + near_copies(rng, 60, 100, 0.05) + [" ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(50)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in neardup.keep_first(docs).collect()) == expected(texts)


def test_heavy_shingles_go_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "HEAVY", 2 / neardup.SAMPLE)
    texts = texts_of_all_similarities()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in neardup.keep_first(docs).collect()) == expected(texts)


def test_small_tables_are_told_by_rows_and_bytes(spark):
    from lamina.llm.store import small_or_not

    df = spark.range(100).selectExpr("id", "repeat('x', 50) AS t", "array(id, id) AS a", "struct(id, 'abc' AS s) AS st")
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(small_or_not(df)) and not hinted(small_or_not(df, rows=99)) and not hinted(small_or_not(df, size=8000)) and hinted(small_or_not(df, size=11_000))
    assert hinted(small_or_not(df.limit(0)))


def test_texts_of_a_template_are_not_paired(spark, monkeypatch):
    """Texts that share 170 of 200 words are no near copies, and none of their pairs leaves the tasks, however many they are."""
    rng, written = random.Random(3), []
    verified = neardup.verified

    def counted(docs, distinct, pairs, *rest):
        written.append(pairs.count())
        return verified(docs, distinct, pairs, *rest)

    monkeypatch.setattr(neardup, "verified", counted)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    template = [word() for _ in range(170)]
    texts = [" ".join([word() for _ in range(15)] + template + [word() for _ in range(15)]) for _ in range(600)]
    texts += [" ".join(t.split()[:-1]) for t in texts[:20]]  # and some near copies
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert neardup.keep_first(docs).count() == 600
    assert sum(written) < 2 * len(texts)


def test_blocks_of_a_crowded_shingle_hold_every_pair(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 30)
    rows = [(1, b, b % 3, False, b % 7) for b in range(100)] + [(2, b, b % 3, False, b % 7) for b in range(30)]
    placed = spark.createDataFrame(rows, "token long, bag long, comp long, heavy boolean, place int")
    groups: dict[int, set[int]] = {}
    for r in neardup._divided(placed).collect():
        groups.setdefault(r.token, set()).add(r.bag)
    assert groups[2] == set(range(30)) and 1 not in groups
    assert max(len(g) for g in groups.values()) < 60
    met = {(a, b) for g in groups.values() for a in g for b in g if a < b}
    assert met == {(a, b) for a in range(100) for b in range(a + 1, 100)}


def test_sketches_leave_out_no_similar_pair():
    bags = [neardup.bag(t) for t in texts_of_all_similarities()]
    marks = np.stack([neardup.sketch(b).view(np.uint64) for b in bags])
    n = np.array([len(b) for b in bags])
    i, j = np.triu_indices(len(bags), 1)
    near = neardup.sketches_near(marks, n, i, j, 0.8)
    both = np.array([len(np.intersect1d(bags[a], bags[b])) for a, b in zip(i, j)])
    alike = both / np.maximum(n[i] + n[j] - both, 1) >= 0.8
    assert alike.sum() > 300 and near[alike].all()
    assert near[(both < 0.5 * n[i]) & (n[i] > 50)].mean() < 0.01


def test_exact_pass_writes_no_pairs_of_texts_that_share_half(spark):
    """Fingerprints of texts that have half of their shingles in common are near, and each pair meets under dozens of them."""
    rng, rows = np.random.default_rng(4), []
    common = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    for name in range(40):
        bag = np.sort(np.concatenate([common, rng.integers(0, 1 << 63, 160, dtype=np.uint64)]))
        rows += [(token, name, name, len(bag), 7, 0, neardup.sketch(bag).tobytes()) for token in range(20)]
    placed = spark.createDataFrame(rows, "token long, comp long, bag long, n long, fp long, place int, sketch binary").coalesce(1).sortWithinPartitions("token", "comp")
    assert placed.mapInArrow(neardup._rest(0.8), "a long, b long, comp_a long, comp_b long").count() == 0


def test_near_copies_are_written_about_once(spark, monkeypatch):
    """Pairs of alike texts meet under dozens of shingles of their prefixes; few of the rows that leave the tasks are repeated."""
    written, distinct = spark.sparkContext.accumulator(0), []
    verified = neardup.verified

    def counted(make):
        def made(similarity):
            run = make(similarity)

            def each(batches):
                for batch in run(batches):
                    written.add(batch.num_rows)
                    yield batch

            return each

        return made

    def told(docs, bags, pairs, *rest):
        distinct.append(pairs.count())
        return verified(docs, bags, pairs, *rest)

    monkeypatch.setattr(neardup, "_nearest", counted(neardup._nearest))
    monkeypatch.setattr(neardup, "_rest", counted(neardup._rest))
    monkeypatch.setattr(neardup, "verified", told)
    rng, texts = random.Random(8), []
    for group in (2, 3, 5, 7) * 4:
        texts += near_copies(rng, 300, group, 0.03)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)  # repeated rows are dropped within a batch
    try:
        assert sorted(r.doc_id for r in neardup.keep_first(docs).collect()) == expected(texts)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(distinct) > 2 and written.value < 4 * sum(distinct[1:])  # the first are pairs of fingerprints


def test_texts_meet_under_the_first_shingle_that_they_share(spark):
    """The rules that leave pairs out under a shingle never do so under the first that both have."""
    rng = random.Random(2)
    bags = {name: sorted(rng.sample(range(60), 20)) for name in range(30)}
    rows = [(token, name, place) for name, own in bags.items() for place, token in enumerate(own)]
    shared = spark.createDataFrame(rows, "token long, bag long, place int").coalesce(1).sortWithinPartitions("token").mapInArrow(neardup._shared, "token long, bag long, place int, same long, also long, places long")
    kept = [(r.token, r.bag) for r in neardup._first_of_same(shared).collect()]
    assert {r[:2] for r in rows if sum(r[0] in own for own in bags.values()) > 1} == set(kept)  # no two shingles have the same texts
    for token in range(60):
        own = [r for r in rows if r[0] == token]
        places = np.array([r[2] for r in own])
        before = np.array([np.array([0] * 4 + bags[name][:place], dtype=np.int64)[-4:].tobytes() for _, name, place in own], dtype=object)
        known = neardup.earlier([before], len(own))
        i, j = np.triu_indices(len(own), 1)
        for a, b, out in zip(i, j, neardup.met(known, places, i, j)):
            x, y = (bags[own[k][1]] for k in (a, b))
            assert out == bool({*x[: places[a]][-4:]} & {*y[: places[b]][-4:]})
            assert not (out and min({*x} & {*y}) == token)


def test_of_shingles_of_the_same_texts_the_first_stays(spark):
    rows = [(9, 1, 0), (9, 2, 1), (4, 1, 1), (4, 2, 3), (5, 1, 2), (5, 3, 0), (6, 1, 3), (6, 2, 4), (6, 3, 1), (7, 3, 2)]
    shared = spark.createDataFrame(rows, "token long, bag long, place int").coalesce(1).sortWithinPartitions("token").mapInArrow(neardup._shared, "token long, bag long, place int, same long, also long, places long")
    assert sorted(map(tuple, neardup._first_of_same(shared).collect())) == [(5, 1, 2), (5, 3, 0), (6, 1, 3), (6, 2, 4), (6, 3, 1), (9, 1, 0), (9, 2, 1)]


def test_shingles_of_divided_runs_all_stay(spark, monkeypatch):
    monkeypatch.setattr(neardup, "WHOLE", 4)
    batches = [[(1, b, 0) for b in range(5)], [(1, 5, 0), (2, 0, 1), (2, 1, 1)], [(3, 0, 2), (3, 1, 2)], [(4, 7, 3)]]
    arrow = [neardup.pa.RecordBatch.from_arrays([neardup.pa.array(np.array(c)) for c in zip(*b)], names=["token", "bag", "place"]) for b in batches]
    rows = [tuple(r.values()) for b in neardup._shared(iter(arrow)) for r in b.to_pylist()]
    assert sorted(r[:2] for r in rows) == [(1, b) for b in range(6)] + [(2, 0), (2, 1), (3, 0), (3, 1)]
    same = {t: {r[3:5] for r in rows if r[0] == t} for t in (1, 2, 3)}
    assert len(same[1]) == 1 and same[2] == same[3] and same[1] != same[2]
