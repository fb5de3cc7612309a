"""Token files: round trips of the coder, the encoder against the library, and documents against a plain reading."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lamina.llm import rans, token_files
from lamina.llm.queries import vocabulary_path

FILE = vocabulary_path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)
ENCODER = token_files.Encoder(FILE)
ODD = ["", None, " ", "  a  b ", "\n\n a\n b", "the the the", "it's 'll be 've", "é ñ́ 日本 🙂", "a b  c", "x <|endoftext|> y", "y" * 5000, "a b " * 30_000, "\x1c a \x85 b ᠎ c ​ d ﻿ e", "1 2 ,3 !4", "same", "same"]


def plain(text: str | None) -> list[int]:
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 70_000, rans.BLOCK + 1])
@pytest.mark.parametrize("kind", ["one", "skew", "wide", "large"])
def test_frames_give_the_ids_back(n, kind):
    rng = np.random.default_rng(n)
    make = {"one": lambda: np.full(n, 7), "skew": lambda: rng.zipf(1.3, n) % 50_257, "wide": lambda: rng.integers(0, 50_257, n), "large": lambda: rng.integers(0, 1 << 32, n)}
    ids = make[kind]().astype("<u4")
    frame = rans.Frame(rans.encode(ids))
    assert (frame.ids() == ids).all() and len(frame.ids()) == n
    if n > 300:  # any part alone
        parts = [(b, c) for b in range(len(frame.begins) - 1) for c in range(frame.checkpoints(b))]
        assert len(parts) > 1 or n < 512
        last = frame.segment(*parts[-1])
        assert (last == ids[n - len(last) :]).all()


def test_size_is_near_the_entropy():
    ids = (np.random.default_rng(1).zipf(1.2, 300_000) % 50_257).astype("<u4")
    share = np.bincount(ids) / len(ids)
    share = share[share > 0]
    frame = rans.Frame(rans.encode(ids))
    assert len(frame.data) < 1.06 * -(share * np.log2(share)).sum() * len(ids) / 8 + len(frame.table.to_bytes())
    assert int(frame.table.frequency.sum()) == 1 << frame.bits


def test_damage_is_found():
    data = rans.encode((np.arange(20_000) % 977).astype("<u4"))
    for at in [0, 3, len(data) - 1, len(data) // 2, len(data) // 3]:
        bad = bytearray(data)
        bad[at] ^= 0x40
        with pytest.raises(ValueError):
            rans.Frame(bytes(bad)).ids()
    for cut in (0, 3, 20, len(data) - 4):
        with pytest.raises(ValueError):
            rans.Frame(data[:cut]).ids()


@given(st.lists(st.one_of(st.text(max_size=40), st.text("ab '\n\t \x85s.1é<|endoftext|>", max_size=40)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in ENCODER.encode(pa.array(texts, pa.string()))] == [plain(t)[:-1] for t in texts]


def test_word_is_encoded_once_whatever_follows_it(monkeypatch):
    once, met = token_files.Encoder(FILE), []
    monkeypatch.setattr(once, "learn", lambda words, learn=once.learn: (met.extend(words), learn(words)))
    tails = ["", ",", ".", "!?", "'s", "'t,", ".\nThen", "\n\nThen", "-1", "(2)", "1a", ".\u00e9", "\u0301a!", "\u03b1!", "\u2019s", "\n", ".\u00a0b!"]
    texts = [f"a Stra\u00dfe{t} of stone{t} {t}" for t in tails] + ["a " + " ".join(f"Stra\u00dfe{t}" for t in tails) + " \u65e5\u672c, stone, of"]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() + [0] for x in once.encode(pa.array(texts))] == [plain(t) for t in texts]
    assert met.count("Stra\u00dfe") == met.count("stone") == 1 and not {"Stra\u00dfe,", "stone.", "stone.\nThen"} & {*met}


def test_encoder_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(token_files, "KEPT", 3)
    small = token_files.Encoder(FILE)
    texts = [t or "" for t in ODD]
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in small.encode(pa.array(texts))] == [plain(t)[:-1] for t in texts]


@pytest.mark.parametrize("frame_ids", [50, token_files.FRAME_IDS])
def test_documents_equal_a_plain_reading(spark, monkeypatch, tmp_path, frame_ids):
    monkeypatch.setattr(token_files, "FRAME_IDS", frame_ids)
    rows = [(i * 7 % 16, t) for i, t in enumerate(ODD)] + [(3, "again"), (None, "no id"), (None, None)] + [(99, "hot row")] * 40
    docs = spark.createDataFrame([(i, t, "s", 1, "p") for i, t in rows], "doc_id long, text string, start string, part int, payload string")
    token_files.write(docs, FILE, str(tmp_path / "t"))
    got = token_files.read(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == sorted(-1 if i is None else i for i, _ in rows)
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(i), plain(t)) for i, t in rows)
    assert all(len(r.ids) == r.n_tokens for r in got)
    sums = {r.start: r.ids_crc32 for r in token_files.checksums(spark, str(tmp_path / "t")).collect()}
    assert sums == {r.start: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    found = token_files.round_trip(empty, FILE)
    assert found.count() == 0 and found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_string_ids_keep_their_order(spark):
    docs = spark.range(300).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("doc_id"), F.lit("a b").alias("text"))
    got = token_files.round_trip(docs, FILE).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(f"d{i}" for i in range(300))
