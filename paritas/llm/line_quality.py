"""Quality of documents from a linear-chain conditional random field over their lines.

Every line is good or bad. A line's state depends on features of the line and of its
neighbours, and on the states beside it; forward-backward gives the marginal probability
that a line is good, and a document's score is the mean over its lines weighted by their
length. Features are shares of characters and words (case, digits, symbols, repetition), so
they need neither language nor source.

Training. Labels are of documents, lines have none: every line of a document labelled good
is good; in a document labelled bad each line starts as bad and is relabelled after each
round by the model's own marginals, though the worst line stays bad. The field is fitted on
at most ``max_docs`` labelled documents, the ones with the smallest hash of their id, read
whole; only their line features reach the driver. Scoring has no such bound.

Scoring is one pass of ``mapInArrow`` without a shuffle; whole texts, every line.

Defined cases: a null or empty text is one empty line and gets that line's marginal; a text
without a newline is one line; weights are at least one per line, so white lines count;
repeated rows get equal scores; labels that contradict each other count as good, of
documents with one id one is learnt from; where the labelled documents are of one class only, every text
gets that class's score (1 or 0), and without any labelled document 0.5;
an empty table of documents gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import python_path, tidy

_RUNS = re.compile(r"[^\w\s.,;:'\"()\-]{2,}")
N_OWN = 11
N_FEATURES = 3 * N_OWN + 1  # of the line, the line before, the line after, and a constant


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line (lines x N_OWN) and the lengths of the lines in characters."""
    rows, lengths = [], []
    seen: dict[str, int] = {}
    for line in text.split("\n"):
        words = line.split()
        n, m = len(line), len(words)
        seen[line] = again = seen.get(line, 0) + 1
        if not m:
            rows.append((1.0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0))
        else:
            letters = n - line.count(" ")
            bars = line.count("|")
            shouts = line.count("!")
            upper = sum(map(str.isupper, words))
            runs = len(_RUNS.findall(line))
            rows.append((
                0.0, upper / m, sum(map(str.isdigit, words)) / m, min(1.0, bars / m), min(1.0, shouts / (2 * m)),
                min(1.0, runs / m), 1 - len(set(words)) / m, sum(map(str.isalpha, words)) / m,
                min(1.0, letters / m / 20), 1.0 if m < 4 else 0.0, 1.0 if again > 1 else 0.0))
        lengths.append(max(1, n))
    return np.array(rows, np.float64), np.array(lengths, np.float64)


def with_neighbours(own: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows of features with those of the lines before and after in the same document (zeros at
    its ends) and a constant. ``starts``: the first line of each document."""
    first = np.zeros(len(own), bool)
    first[starts] = True
    before = np.vstack([np.zeros((1, own.shape[1])), own[:-1]]) * ~first[:, None]
    last = np.r_[first[1:], True]
    after = np.vstack([own[1:], np.zeros((1, own.shape[1]))]) * ~last[:, None]
    return np.hstack([own, before, after, np.ones((len(own), 1))])


@dataclass
class Field:
    """Weights: ``state`` (features) adds to the good state's score of a line, ``pair`` (2 x 2)
    to the score of two states side by side (0 bad, 1 good)."""

    state: np.ndarray
    pair: np.ndarray


def constant(score: float) -> Field:
    """The field that gives every text about ``score``: 0, 0.5 or 1."""
    state = np.zeros(N_FEATURES)
    state[-1] = 60 * (2 * score - 1)
    return Field(state, np.zeros((2, 2)))


def forward_backward(emit: np.ndarray, pair: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(good) per line, P(states of this and the next line) per line (zeros at a document's last
    line), and log Z per document, for the good state's scores ``emit`` of lines of whole
    documents. All documents move one line per step together, longest first."""
    sizes = np.diff(np.r_[starts, len(emit)])
    order = np.argsort(-sizes, kind="stable")
    begin, size = starts[order], sizes[order]
    alive = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right") if len(size) else []
    e = np.exp(np.clip(np.stack([np.zeros_like(emit), emit], 1) - np.maximum(emit, 0)[:, None], -60, 0))
    t = np.exp(pair)
    f, b, scale = np.empty_like(e), np.ones_like(e), np.empty(len(emit))
    for k, n in enumerate(alive):
        at = begin[:n] + k
        a = e[at] if not k else (f[at - 1] @ t) * e[at]
        scale[at] = a.sum(1)
        f[at] = a / scale[at, None]
    for k in range(len(alive) - 2, -1, -1):
        at = begin[: alive[k + 1]] + k
        v = (e[at + 1] * b[at + 1]) @ t.T
        b[at] = v / scale[at + 1, None]
    good = f * b
    good = good[:, 1] / good.sum(1)
    both = np.zeros((len(emit), 2, 2))
    inner = np.ones(len(emit), bool)
    inner[starts[1:] - 1] = False
    inner[-1:] = False
    at = np.flatnonzero(inner)
    both[at] = f[at][:, :, None] * t * (e[at + 1] * b[at + 1])[:, None, :] / scale[at + 1, None, None]
    log_z = np.add.reduceat(np.log(scale) + np.maximum(emit, 0), starts) if len(starts) else np.zeros(0)
    return good, both, log_z


def fit(own: list[np.ndarray], labels: np.ndarray, rounds: int = 4, steps: int = 60, ridge: float = 1e-3) -> Field:
    """Conditional likelihood by gradient ascent with momentum; lines of bad documents are
    relabelled after each round."""
    starts = np.cumsum([0, *map(len, own)])[:-1]
    x = with_neighbours(np.vstack(own), starts)
    doc = np.repeat(np.arange(len(own)), [len(o) for o in own])
    y = labels[doc].astype(np.float64)
    share = np.bincount(labels, minlength=2) / len(labels)
    weight = (0.5 / share)[labels]  # both classes weigh the same
    inner = np.ones(len(x), bool)
    inner[np.r_[starts[1:], len(x)] - 1] = False
    at = np.flatnonzero(inner)
    field, speed_s, speed_p = Field(np.zeros(x.shape[1]), np.zeros((2, 2))), 0.0, 0.0
    norm = (weight[doc]).sum()
    for k in range(rounds):
        for _ in range(steps):
            good, both, _ = forward_backward(x @ field.state, field.pair, starts)
            g_s = x.T @ (weight[doc] * (y - good)) / norm - ridge * field.state
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[at].astype(int), y[at + 1].astype(int)), weight[doc[at]])
            g_p = (seen - (both * weight[doc][:, None, None]).sum(0)) / norm - ridge * field.pair
            speed_s, speed_p = 0.9 * speed_s + g_s, 0.9 * speed_p + g_p
            field.state, field.pair = field.state + 1.0 * speed_s, field.pair + 0.3 * speed_p
        if k < rounds - 1:  # lines the model takes for good in bad documents
            own_view = 1 / (1 + np.exp(-(x @ field.state)))
            worst = np.zeros(len(x), bool)
            for i in np.flatnonzero(labels == 0):
                s = starts[i]
                worst[s + np.argmin(own_view[s: s + len(own[i])])] = True
            y = np.where(labels[doc] == 1, 1.0, np.where((own_view > 0.5) & ~worst, 1.0, 0.0))
    return field


def score_texts(texts: list[str], field: Field) -> np.ndarray:
    """Length-weighted mean marginal of each text."""
    parts = [line_features(t) for t in texts]
    if not parts:
        return np.zeros(0)
    starts = np.cumsum([0, *(len(p[0]) for p in parts)])[:-1]
    x = with_neighbours(np.vstack([p[0] for p in parts]), starts)
    good, _, _ = forward_backward(x @ field.state, field.pair, starts)
    w = np.concatenate([p[1] for p in parts])
    return np.clip(np.add.reduceat(good * w, starts) / np.add.reduceat(w, starts), 0.0, 1.0)


def _features(batches):
    for b in batches:
        got = [line_features(t or "") for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("label"), pa.array([g[0].astype(np.float32).tobytes() for g in got], pa.binary())], ["label", "own"])


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 3000) -> Field:
    """Fit on the texts of ``docs(doc_id, text)`` that ``labels(doc_id, label)`` calls 1 (good) or 0 (bad)."""
    python_path(docs.sparkSession)
    known = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most max_docs ids
    rows = texts.dropDuplicates(["doc_id"]).select("label", "text").mapInArrow(_features, "label int, own binary").collect()
    rows = sorted((r["label"], bytes(r["own"])) for r in rows)  # the fit does not depend on the order of tasks
    labels_ = np.array([r[0] for r in rows], np.int64)
    if len(set(labels_.tolist())) < 2:
        return constant(float(labels_[0]) if len(labels_) else 0.5)
    return fit([np.frombuffer(r[1], np.float32).reshape(-1, N_OWN).astype(np.float64) for r in rows], labels_)


def _score(field: Field, names: list[str], name: str):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                s = score_texts([t or "" for t in b.column("text").to_pylist()], field)
                yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(s, pa.float64())], [*names, name])

    return run


def score(docs: DataFrame, field: Field, keep: list[str], name: str = "score") -> DataFrame:
    """``keep`` columns of ``docs`` with the score of ``text`` in column ``name``."""
    python_path(docs.sparkSession)
    if name in keep:
        raise ValueError(f"{name!r} is a column of the input already")
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = rows.select(*keep).schema.add(name, "double")
    return rows.mapInArrow(tidy(_score(field, keep, name)), schema)
