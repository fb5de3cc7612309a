"""The corpus pipeline against its operators taken one by one."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from lamina.llm import decontaminate, secrets, simhash, toxicity
from lamina.llm.queries import queries, table, vocabulary_path

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_run_equals_its_stages_by_brute_force(spark):
    docs = table(spark, SF, "documents")
    scores = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.train(docs, table(spark, SF, "labels"))).collect()}
    rest = [r for r in docs.collect() if not scores[r.doc_id]]
    bags = {r.doc_id: simhash.shingle_hashes(r.text, 5) for r in rest}
    root = {i: i for i in bags}
    for i in bags:
        for j in bags:
            if j < i and root[i] != root[j] and (sorted(bags[i]) == sorted(bags[j]) or decontaminate.weighted_similarity(bags[i], bags[j]) >= 0.8):
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    kept = [r for r in rest if root[r.doc_id] == r.doc_id]
    leaked = {r.doc_id for r in decontaminate.matches(docs, table(spark, SF, "benchmark")).collect()}
    kept = {r.doc_id: r.text for r in kept if r.doc_id not in leaked}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(kept)
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    network = secrets.default_network()
    import pyarrow as pa

    for i, text in kept.items():
        parts, at = [], 0
        for s, _, e in secrets.find(pa.array([text]), network)[0]:
            if s >= at:
                parts += [text[at:s], "[SECRET]"]
            at = max(at, e)
        assert list(got[i].token_ids) == library.encode("".join(parts) + text[at:], add_special_tokens=False).ids


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = out.limit(150)


def test_every_query_runs(spark):
    for name, query in queries().items():
        assert query(spark, SF).columns, name


def edge_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns named like the stages' own."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _gone_id long, _gone_key long, root long, fp long, score double, label int, half int, key string, stats string, hash long, copy int"
    texts = [None, "", " ", "a", "idiot moron scum " * 3, "password=abcdefgh1", "w " * 30_000, "same text of two", "same text of two", "日本語"]
    rows = [(i, t, None if i % 2 else "en", None, None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(None, "no id", None, None, 5), (None, None, None, None, None), (7, "same text of two", "en", "s", 16), (3, "another of id 3", "en", "s", 15)]
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 0.5, 1, 0, "k", "s", 5, 1) for r in rows], schema)


def test_stages_on_edge_cases(spark):
    docs = edge_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        if name == "bpe":
            assert out.count() == docs.count()
            continue
        assert out.columns == docs.columns, name
        texts = [r.text for r in out.collect()]
        if name == "simhash_near_dedup":
            assert texts.count("same text of two") == 1 and texts.count("no id") == 1 and texts.count("another of id 3") == 1
        if name == "secret_scan":
            assert len(texts) == docs.count() and "[SECRET]" in texts
        if name == "decontamination":
            assert len(texts) == docs.count()
