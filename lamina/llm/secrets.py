"""Secrets in texts: fixed patterns, and a character convolutional network over every further candidate."""

from __future__ import annotations

import hashlib
import random
import re
import string
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.words import id_type, map_texts, text_buffer, text_udf

#: The kinds in their order, their patterns, the group that has a least length, and that length.
KINDS = (
    ("assign", re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
LEARNED = "learned"

#: A candidate is a run of these characters of at least LEAST, with a digit and a letter.
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
LEAST = 16
_IN = np.zeros(256, dtype=bool)
_IN[list(ALPHABET.encode())] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True

#: Characters that the network sees at a time: before the window, of the candidate in it, and after it.
BEFORE, INSIDE, AFTER = 24, 48, 8
LENGTH = BEFORE + INSIDE + AFTER
#: A longer candidate is seen in windows that begin so many characters apart, the last one at its end.
STEP = 24
#: Windows that are scored at a time.
BATCH = 1024
TAPS, FILTERS, EPOCHS, FINDINGS = 5, 16, 14, 3000
#: The share of true secrets that the threshold keeps on findings that the network wasn't fitted on.
RECALL = 0.98

_CODES = np.zeros(128, dtype=np.int64)
for _n, _c in enumerate(string.printable.strip() + " \n", start=2):
    _CODES[ord(_c)] = _n
_SYMBOLS = 2 + len(string.printable.strip()) + 2


def encode(text: str, start: int, end: int) -> Iterator[np.ndarray]:
    """Rows of numbers of the characters in and around each window of a candidate, at most BATCH rows at a time.

    What comes before a window, what is in it, and what comes after it have numbers of their own. 0: none.
    """
    low, size = max(0, start - BEFORE), min(INSIDE, end - start)
    points = np.frombuffer(text[low : end + AFTER].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.zeros(BEFORE + end - start + AFTER, dtype=np.int64)
    there = np.zeros(len(codes), dtype=np.int64)
    at = slice(BEFORE - (start - low), BEFORE - (start - low) + len(points))
    codes[at], there[at] = np.where(points < 128, _CODES[np.minimum(points, 127)], 1), 1
    regions = [(0, 0, BEFORE), (BEFORE, BEFORE, size), (BEFORE + INSIDE, BEFORE + size, AFTER)]
    starts = np.unique(np.append(np.arange(0, end - start - size + 1, STEP), end - start - size))
    for i in range(0, len(starts), BATCH):
        some = starts[i : i + BATCH]
        out = np.zeros((len(some), LENGTH), dtype=np.int64)
        for region, (to, source, n) in enumerate(regions):
            place = some[:, None] + source + np.arange(n)[None, :]
            out[:, to : to + n] = codes[place] + region * _SYMBOLS * there[place]
        yield out


@dataclass
class Network:
    """Convolution over characters, the greatest and the mean of each filter, one hidden layer, a calibrated sigmoid."""

    taps: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 0.5
    #: The share of secrets over the threshold, of the findings that gave it.
    recall: float = 0.0

    def forward(self, x: np.ndarray):
        n = x.shape[1] - TAPS + 1
        conv = self.bias + sum(self.taps[j][x[:, j : j + n]] for j in range(TAPS))
        conv = np.maximum(conv, 0)
        pooled = np.concatenate([conv.max(axis=1), conv.mean(axis=1)], axis=1)
        h = np.maximum(pooled @ self.hidden + self.hidden_bias, 0)
        return conv, pooled, h, h @ self.out + self.out_bias

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(x[i : i + 256])[3] for i in range(0, len(x), 256)]) if len(x) else np.zeros(0)

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.offset, -35, 35)))

    def scores(self, candidates: Iterable[tuple[str, int, int]]) -> np.ndarray:
        """For each candidate (text, start, end) the greatest score of its windows; only BATCH windows are held at a time."""
        best: list[float] = []
        held, owner, size = [], [], 0

        def flush() -> None:
            nonlocal held, owner, size
            if size:
                np.maximum.at(found := np.array(best), np.concatenate(owner), self.logits(np.concatenate(held)))
                best[:] = found.tolist()
            held, owner, size = [], [], 0

        for n, (text, start, end) in enumerate(candidates):
            best.append(-np.inf)
            for rows in encode(text, start, end):
                held.append(rows)
                owner.append(np.full(len(rows), n))
                size += len(rows)
                if size >= BATCH:
                    flush()
        flush()
        return self.calibrated(np.array(best))


def train(findings: list[tuple[str, int, int, int]], recall: float = RECALL, seed: int = 3) -> Network:
    """A network fitted on all windows of labelled findings (text, start, end, label), label 1 for a secret.

    Every fifth finding is kept for Platt's calibration of the score and for the threshold: the greatest that still keeps
    the share recall of that part's secrets, a finding being worth its best window.
    """
    rng = np.random.default_rng(seed)
    windows = [np.concatenate(list(encode(*f[:3]))) for f in findings]
    owner = np.repeat(np.arange(len(findings)), [len(w) for w in windows])
    x, label = np.concatenate(windows), np.array([f[3] for f in findings], dtype=np.float64)
    y = label[owner]
    aside = owner % 5 == 4
    net = Network(rng.normal(0, 0.25, (TAPS, 3 * _SYMBOLS, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.2, (2 * FILTERS, 16)), np.zeros(16), rng.normal(0, 0.2, 16), 0.0)
    names = ("taps", "bias", "hidden", "hidden_bias", "out", "out_bias")
    moments = {k: [np.zeros_like(np.asarray(getattr(net, k), dtype=float)) for _ in range(2)] for k in names}
    step, rows = 0, np.flatnonzero(~aside)
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(rows), max(1, len(rows) // 64)):
            a, t = x[part], y[part]
            conv, pooled, h, logit = net.forward(a)
            d = (1 / (1 + np.exp(-np.clip(logit, -35, 35))) - t) / len(part)
            dh = np.outer(d, net.out) * (h > 0)
            dpool = dh @ net.hidden.T
            n = conv.shape[1]
            dconv = np.repeat(dpool[:, None, FILTERS:] / n, n, axis=1)
            i, k = np.meshgrid(np.arange(len(part)), np.arange(FILTERS), indexing="ij")
            dconv[i, conv.argmax(axis=1), k] += dpool[:, :FILTERS]
            dconv *= conv > 0
            flat = dconv.reshape(-1, FILTERS)
            dtaps = np.zeros_like(net.taps)
            for j in range(TAPS):
                np.add.at(dtaps[j], a[:, j : j + n].ravel(), flat)
            grads = {"taps": dtaps + 1e-4 * net.taps, "bias": flat.sum(axis=0), "hidden": pooled.T @ dh, "hidden_bias": dh.sum(axis=0), "out": h.T @ d, "out_bias": d.sum()}
            step += 1
            for k2 in names:
                m, v = moments[k2]
                m += 0.1 * (grads[k2] - m)
                v += 0.001 * (grads[k2] ** 2 - v)
                setattr(net, k2, getattr(net, k2) - 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8))
    logits = np.full(len(findings), -np.inf)
    np.maximum.at(logits, owner[aside], net.logits(x[aside]))
    logits, labels = logits[4::5], label[4::5]
    for _ in range(200):  # Platt's scaling
        p = net.calibrated(logits)
        net.slope -= 0.05 * float(np.mean((p - labels) * logits) + 1e-3 * (net.slope - 1))
        net.offset -= 0.05 * float(np.mean(p - labels))
    kept = np.sort(net.calibrated(logits)[labels == 1])
    if len(kept):
        net.threshold = float(kept[int(np.floor((1 - recall) * len(kept)))])
        net.recall = float((kept >= net.threshold).mean())
    return net


def labelled_findings(count: int = FINDINGS, seed: int = 5) -> list[tuple[str, int, int, int]]:
    """Findings with labels, made by rule: secrets of many shapes in their usual surroundings, and what looks like them."""
    rng = random.Random(seed)
    pick = rng.choice
    some = lambda chars, low, high: "".join(rng.choices(chars, k=rng.randint(low, high)))
    word = lambda: "".join(pick(("an", "the", "re", "ing", "er", "on", "ti", "sch", "de", "que", "mo", "lu", "ta", "pro")) for _ in range(rng.randint(1, 4)))
    mixed, upper, lower = string.ascii_letters + string.digits, string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits

    def full(make):
        while True:
            c = make()
            if len(c) >= LEAST and re.search("[0-9]", c) and re.search("[A-Za-z]", c):
                return c

    secrets = (
        lambda: some(mixed, 20, 44), lambda: some(mixed + "+/", 28, 60) + pick(("", "=", "==")), lambda: some(lower, 18, 40), lambda: some(upper, 18, 32), lambda: some("0123456789abcdef", 16, 64),
        lambda: pick(("gh", "sk", "pk", "xox", "gl", "AIza", "SG", "npm")) + pick(("p_", "o_", "-", "_live_", "_test_", "b-", "pat-")) + some(mixed, 16, 40), lambda: "AKIA" + some(upper, 14, 20), lambda: "eyJ" + some(mixed + "_-", 24, 60),
    )
    harmless = (
        lambda: "-".join(word() for _ in range(rng.randint(3, 6))) + pick(("-", "_")) + str(rng.randint(1, 2030)), lambda: "/".join(word() for _ in range(rng.randint(3, 6))) + "/" + str(rng.randint(1, 999)),
        lambda: f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}T{rng.randint(0, 23):02d}-{rng.randint(0, 59):02d}-{rng.randint(0, 59):02d}Z", lambda: "_".join(word() for _ in range(rng.randint(2, 5))) + str(rng.randint(0, 99)) + word(),
        lambda: word().capitalize() + word().capitalize() + word().capitalize() + word().capitalize() + str(rng.randint(0, 99)), lambda: pick("=-_+") * rng.randint(12, 50) + word() + str(rng.randint(0, 9)), lambda: "/" + word() + "/" + word() + "/page" + str(rng.randint(1, 999)) + "/" + word(),
        lambda: "v" + str(rng.randint(1, 9)) + "-" + str(rng.randint(0, 99)) + "-" + word() + "-" + word() + "-" + word(), lambda: "".join(word() for _ in range(5)) + str(rng.randint(0, 9)), lambda: "".join(word() for _ in range(3)) + str(rng.randint(0, 999)) + "".join(word() for _ in range(3)),
        lambda: (some("0123456789", 1, 3) + word()) * rng.randint(3, 8), lambda: str(rng.randint(10**11, 10**18)) + word(),
    )
    cues = ("key: ", "auth = ", "Authorization: Bearer ", "pwd=", "credential ", "access_key='", "private key ", "client_id=", 'api": "', "export TOKEN=", "login ", "use ", "")
    out = []
    for n in range(count):
        label = n % 2
        candidate = full(pick(secrets) if label else pick(harmless))
        before = " ".join(word() for _ in range(rng.randint(0, 6))) + pick((" ", "\n", "", ": ", ", "))
        before += pick(cues) if rng.random() < (0.6 if label else 0.15) else ""
        before = before if not before or not re.search(r"[A-Za-z0-9+/_=-]$", before) else before + " "
        after = pick((" ", ".", '"', "'", "\n", ",", ";", "")) + " ".join(word() for _ in range(rng.randint(0, 3)))
        after = after if not re.match(r"[A-Za-z0-9+/_=-]", after) else " " + after
        out.append((before + candidate + after, len(before), len(before) + len(candidate), label))
    return out


@lru_cache(maxsize=1)
def default_network() -> Network:
    return train(labelled_findings())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by start and then kind."""
    spans = []
    for kind, (_, pattern, group, least) in enumerate(KINDS):
        if kind == 0 and "=" not in text and ":" not in text or kind == 1 and "AKIA" not in text:
            continue
        spans += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(spans)


def candidate_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end, letters and digits both) of every run of LEAST or more characters of ALPHABET, in bytes of the text."""
    data, offsets = text_buffer(texts)
    inside = np.concatenate(([False], _IN[data], [False]))
    if not len(data):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)
    edges = np.concatenate((np.flatnonzero(inside[1:] != inside[:-1]), offsets[(offsets > 0) & (offsets < len(data))]))
    edges = np.unique(edges)
    start, end = edges[:-1], edges[1:]
    keep = _IN[data[start]] & (end - start >= LEAST)
    start, end = start[keep], end[keep]
    digits, letters = (np.concatenate(([0], np.cumsum(kind[data]))) for kind in (_DIGIT, _LETTER))
    both = (digits[end] > digits[start]) & (letters[end] > letters[start])
    doc = np.searchsorted(offsets, start, side="right") - 1
    return doc, start - offsets[doc], end - offsets[doc], both


def find(texts: pa.Array, network: Network) -> list[list[tuple[int, int, int]]]:
    """All spans (start, kind, end) of each text by start and kind, in code points; the last kind is the network's own.

    The network judges every candidate but those wholly inside a span of a fixed pattern, from end to end. A candidate that
    such a span touches or lies in is judged and reported as a whole, beside that span.
    """
    doc, start, end, both = candidate_bytes(texts)
    strings = texts.to_pylist()
    longest = np.zeros(len(strings), dtype=bool)
    longest[doc] = True
    found, owners = [], []
    runs: dict[int, list[tuple[int, int]]] = {}
    for d, s, e in zip(doc[both].tolist(), start[both].tolist(), end[both].tolist()):
        runs.setdefault(d, []).append((s, e))
    for d, text in enumerate(strings):
        text = text or ""
        base = base_spans(text) if longest[d] or "=" in text or ":" in text else []  # other kinds need a long run
        found.append(base)
        if d in runs:
            own = runs[d]
            if not text.isascii():  # from bytes to code points: less the later bytes of characters before
                later = np.cumsum((np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8) & 0xC0) == 0x80)
                own = [(s - int(later[s]), e - int(later[e - 1])) for s, e in own]
            covered = Covered(base)
            owners += [(d, s, e) for s, e in own if not covered.inside(s, e)]
    for (d, s, e), p in zip(owners, network.scores((strings[d], s, e) for d, s, e in owners).tolist()):
        if p >= network.threshold:
            found[d].append((s, len(KINDS), e))
    return [sorted(spans) for spans in found]


class Covered:
    """Tells whether a place lies wholly in one of some spans, by bisection."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts = [s for s, _, _ in spans]
        self.ends = list(accumulate((e for _, _, e in spans), max))

    def inside(self, start: int, end: int) -> bool:
        at = bisect_right(self.starts, start)
        return at > 0 and self.ends[at - 1] >= end


def _named(spans: list[tuple[int, int, int]]) -> str:
    names = [k[0] for k in KINDS] + [LEARNED]
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, network: Network | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every row of docs, in one pass without a shuffle.

    Columns: doc_id, n_assign, n_access, n_hex (long), base_sha256 (digest of the fixed patterns' spans), spans (all, as
    kind:start:end by start and then kind, joined by commas; code points, end exclusive). A null or empty text has none;
    ids may be null; repeated rows give repeated rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network or default_network())  # of fixed size, under 1 MB

    def make():
        net = shared.value

        def f(ids: pa.Array, texts: pa.Array) -> list:
            rows = find(texts, net)
            counts = [np.array([sum(k == kind for _, k, _ in r) for r in rows], dtype=np.int64) for kind in range(len(KINDS))]
            digests = [hashlib.sha256(_named([s for s in r if s[1] < len(KINDS)]).encode()).hexdigest() for r in rows]
            return [ids, *counts, pa.array(digests), pa.array([_named(r) for r in rows])]

        return f

    fields = [("doc_id", id_type(docs, id_col)), *((f"n_{k[0]}", T.LongType()) for k in KINDS), ("base_sha256", T.StringType()), ("spans", T.StringType())]
    return map_texts(docs, fields, make, id_col, text_col)


def redact(docs: DataFrame, network: Network | None = None, mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """docs with each secret in the text replaced by mark; spans that overlap are replaced by one. A null text stays null.

    A column n_chars, if there is one, is counted anew.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network or default_network())

    def make():
        net = shared.value

        def f(texts: pa.Array) -> pa.Array:
            out = []
            for text, spans in zip(texts.to_pylist(), find(texts, net)):
                if spans:
                    parts, at = [], 0
                    for s, _, e in spans:
                        if s >= at:
                            parts += [text[at:s], mark]
                        at = max(at, e)
                    text = "".join(parts) + text[at:]
                out.append(text)
            return pa.array(out, pa.string())

        return f

    done = docs.withColumn(text_col, text_udf(make, "string")(F.col(text_col).cast("string")))
    return done.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done
