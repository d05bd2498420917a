"""Benchmark decontamination by latent semantic retrieval.

1. Words of the benchmark are the terms. Their document frequencies come from one pass over
   all documents (partial sums per task).
2. The benchmark's TF-IDF passages (each item, and its stretches of two steps of ``BASE`` words)
   span a latent space by a randomised SVD distributed over them: Z = A'(A R) for a random R, an
   orthonormal basis Q of Z, the Gram matrix of A Q, and from its eigenvectors the ``RANK`` leading
   right singular vectors of A. Both sums are taken per term, or per row of the Gram matrix, by
   Spark. The leading directions of the corpus itself are its most common words, which do not tell items apart.
3. Every document is cut into overlapping passages, for each item size of so many steps, that
   start a quarter of the size apart. Candidates are the pairs whose cosine, folded passage against item in the
   latent space over the passage's TF-IDF length, reaches ``cosine``.
4. Candidates are checked on words, of the passage with a margin of half the size on both sides: first
   by counts (words of the item, no term more often than in the item: at least the common
   subsequence), then by the longest common subsequence of item and passage. A share of
   ``verbatim`` of the item is a copy; a share of ``paraphrase`` is a leak when the item's answer
   (its last sentence) is there by a share of ``answer``. Items of under ``SHORT`` words must stand there
   word for word; any neighbours outweigh so few words, so they are found by the counts alone.
   With ``exact=True`` all items are, which leaves out nothing that the check accepts.

The benchmark is worked through in blocks of ``BLOCK`` items (and 2^16 - 2 terms) at most, so the rank
holds as many directions as a block has items whatever the size of the benchmark; one block's index
is alive at a time, its result is written, and each block is one more pass over the documents. Whole
texts are read; no row is shuffled but the frequency sums.

Defined cases: a null or empty text has no match, a null or wordless item and one without an id match nothing;
repeated items match each; rows that repeat a ``doc_id`` give one row per item with the best
match; empty tables give no matches; other columns pass through ``clean`` untouched.
"""

from __future__ import annotations

import re
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paritas.llm.common import python_path, tidy, written

_WORD = re.compile(r"\w+")
BLOCK, SHORT, RANK, COSINE = 256, 8, 256, 0.2
BASE = 8  # words of a step; passages are whole steps long
MATCHES = "doc_id long, item_id long, cosine double, overlap double, answer double"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def answer_of(text: str) -> str:
    """The last sentence with a word in it."""
    parts = [s for s in re.split(r"(?<=[.!?])\s+|\n", text.strip()) if _WORD.search(s)]
    return parts[-1] if parts else ""


class Terms:
    """Texts as term numbers (16 bits each, 0 for words that are no term)."""

    def __init__(self, number: dict[str, int]):
        self.code = {w: array("H", [n]).tobytes() for w, n in number.items()}
        self.none = array("H", [0]).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.code.get, words_of(text), repeat(self.none))), np.uint16)


def common_subsequence(item: list[int], span: list[int]) -> int:
    """Length of the longest common subsequence; one bit per word of the item."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for w in span:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def stands_in(item: list[int], span: list[int]) -> bool:
    n = len(item)
    return any(span[i: i + n] == item for i in range(len(span) - n + 1))


# ---- the latent space of a block of items -------------------------------------------------


def _frequencies(number: dict[str, int]):
    def run(batches):
        terms, seen, n = Terms(number), np.zeros(len(number) + 1, np.int64), 0
        for b in batches:
            for t in b.column("text").to_pylist():
                seen[np.unique(terms.encode(t))] += 1
            n += b.num_rows
        seen[0] = n
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], ["term", "n"])

    return run


def _tf_idf(terms: Terms, idf: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
    t, n = np.unique(terms.encode(text), return_counts=True)
    return t[t > 0], (n * idf[t])[t > 0]


def _power(number: dict[str, int], idf: np.ndarray, start: np.ndarray):
    """Rows of A'(A R), one per term met."""
    def run(batches):
        terms, z = Terms(number), np.zeros(start.shape)
        for b in batches:
            for x in b.column("text").to_pylist():
                t, w = _tf_idf(terms, idf, x)
                z[t] += np.outer(w, w @ start[t])
        at = np.flatnonzero(z.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(c) for c in z[at].T)], ["term", *(f"y{i}" for i in range(z.shape[1]))])

    return run


def _gram(number: dict[str, int], idf: np.ndarray, basis: np.ndarray):
    """Rows of (A Q)'(A Q)."""
    def run(batches):
        terms, g = Terms(number), np.zeros((basis.shape[1], basis.shape[1]))
        for b in batches:
            for x in b.column("text").to_pylist():
                t, w = _tf_idf(terms, idf, x)
                y = w @ basis[t]
                g += np.outer(y, y)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(g), dtype=np.int32)), *(pa.array(c) for c in g.T)], ["term", *(f"y{i}" for i in range(len(g)))])

    return run


def _summed(df: DataFrame, work, rows: int, width: int) -> np.ndarray:
    """Sum over tasks of a matrix whose rows ``work`` emits; rows and width are bounded by the block."""
    names = [f"y{i}" for i in range(width)]
    parts = df.select("text").mapInArrow(work, "term int, " + ", ".join(f"{n} double" for n in names))
    got = parts.groupBy("term").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
    out = np.zeros((rows, width))
    out[got.column("term").to_numpy()] = np.stack([got.column(n).to_numpy() for n in names], 1)
    return out


def passages(items: DataFrame) -> DataFrame:
    """The rows of the TF-IDF matrix: each item, and its stretches of two steps that begin a step apart, so that
    a small benchmark too has more passages than the space has directions."""
    def run(batches):
        for b in batches:
            out = []
            for t in b.column("text").to_pylist():
                words = words_of(t)
                out.append(t)
                out += [" ".join(words[k: k + 2 * BASE]) for k in range(0, max(0, len(words) - BASE), BASE)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["text"])

    return items.select("text").mapInArrow(run, "text string")


def singular_vectors(items: DataFrame, number: dict[str, int], idf: np.ndarray, rank: int, seed: int = 11) -> np.ndarray:
    """Leading right singular vectors (terms x rank) of the items' TF-IDF matrix."""
    width = rank + 8
    start = np.random.default_rng(seed).standard_normal((len(idf), width))
    z = _summed(items, _power(number, idf, start), len(idf), width)
    basis, _ = np.linalg.qr(z)
    gram = _summed(items, _gram(number, idf, basis), basis.shape[1], basis.shape[1])
    _, vectors = np.linalg.eigh(gram)
    return basis @ vectors[:, ::-1][:, :rank]


class Index:
    """What a task needs of a block of items: terms, folded terms, items by passage size."""

    def __init__(self, rows: list[tuple[int, str]], number: dict[str, int], idf: np.ndarray, vectors: np.ndarray,
                 verbatim: float, paraphrase: float, answer: float, cosine: float, exact: bool):
        self.cosine, self.exact = cosine, exact
        self.number, self.weights = number, idf.astype(np.float32)
        self.folded = (idf[:, None] * vectors).astype(np.float32)
        self.verbatim, self.paraphrase, self.answer = verbatim, paraphrase, answer
        self.least = min(verbatim, paraphrase)
        terms, self.items, self.answers, self.latent, self.sizes = Terms(number), [], [], [], {}
        for item_id, text in rows:
            words = terms.encode(text)
            if not len(words):
                continue
            q = self.folded[words].sum(0)
            self.sizes.setdefault(max(2, -(-len(words) // BASE)), []).append(len(self.items))
            self.latent.append(q / max(1e-12, float(np.sqrt(q @ q))))
            self.items.append((item_id, words.tolist()))
            self.answers.append(terms.encode(answer_of(text)).tolist())
        self.vectors = np.array(self.latent, np.float32).reshape(-1, self.folded.shape[1])
        self.tables: dict | None = None  # made in the task: terms x items

    def _needed(self, item: int) -> int:
        """Words of the item that any accepted passage has."""
        n = len(self.items[item][1])
        return n if n < SHORT else next((k for k in range(1, n) if k / n >= self.least), n)

    def _table(self, which: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items, the words they need, and how often a term (row) stands in an item (255: that often or more)."""
        often = np.zeros((len(self.number) + 1, len(which)), np.uint8)
        for j, i in enumerate(which):
            t, n = np.unique(self.items[i][1], return_counts=True)
            often[t, j] = np.minimum(n, 255)
        return np.array(which), np.array([self._needed(i) for i in which]), often

    def matches(self, docs: list[np.ndarray]) -> list[list[tuple[int, float, float, float]]]:
        """Per document the (item_id, cosine, overlap, answer) of what it leaks."""
        out: list[dict] = [{} for _ in docs]
        if self.tables is None:
            self.tables = {size: self._table(which) for size, which in self.sizes.items()}
            order = [i for which in self.sizes.values() for i in which]
            self.dots = self.folded @ self.vectors[order].T  # of each term with each item, in the latent space
        steps = np.array([-(-len(d) // BASE) for d in docs], np.int64)
        if not self.sizes or not steps.sum():
            return [[] for _ in docs]
        first = np.cumsum(np.r_[0, steps])
        flat = np.zeros(first[-1] * BASE, np.uint16)
        for d, at in zip(docs, first):
            flat[at * BASE: at * BASE + len(d)] = d
        grid = flat.reshape(-1, BASE)
        if not self.exact:
            self._fold(grid)
        at = 0
        for size, (which, need, often) in self.tables.items():
            columns, at = slice(at, at + len(which)), at + len(which)
            apart, side = max(1, size // 4), -(-size // 2)
            count = np.where(steps, 1 - (np.minimum(0, size - steps) // apart), 0)
            ends = np.cumsum(count)
            doc = np.repeat(np.arange(len(docs)), count)
            start = first[doc] + (np.arange(ends[-1]) - np.repeat(ends - count, count)) * apart
            stop = np.minimum(first[doc + 1], start + size)
            low, high = np.maximum(first[doc], start - side), np.minimum(first[doc + 1], start + size + side)
            each = max(1, 1000 // apart)
            for i in range(0, len(start), each):
                w, j = self._pairs(grid, *(x[i: i + each] for x in (start, stop, low, high)), which, need, often, columns)
                for w, j in zip(*self._enough(grid, low[i: i + each], high[i: i + each], need, often, w, j)):
                    d, item = int(doc[i + w]), int(which[j])
                    here, margin = int(start[i + w] - first[d]) * BASE, size * BASE // 2
                    passage = docs[d][here: here + size * BASE]
                    self._check(out[d], item, self._score(passage, item), docs[d][max(0, here - margin): here + size * BASE + margin].tolist())
        return [[(self.items[i][0], *v) for i, v in sorted(o.items())] for o in out]

    def _fold(self, grid: np.ndarray) -> None:
        """Sums over the steps before each step: of every item's dot product with the step folded into the latent
        space (items in the order of the tables; a step folds to the sum of its words, so each word brings
        its own dot products), and of energies (squared weights)."""
        dots, energy = np.zeros((len(grid), self.dots.shape[1]), np.float32), np.zeros(len(grid))
        held = np.empty((2048, dots.shape[1]), np.float32)
        for k in range(0, len(grid), 2048):
            part = grid[k: k + 2048]
            for r in range(BASE):
                dots[k: k + 2048] += np.take(self.dots, part[:, r], axis=0, out=held[: len(part)], mode="clip")
        for r in range(BASE):
            energy += self.weights[grid[:, r]] ** 2
        self.sums = np.zeros((len(grid) + 1, dots.shape[1]))
        for k in range(len(grid)):
            np.add(self.sums[k], dots[k], out=self.sums[k + 1])
        self.energy = np.r_[0.0, np.cumsum(energy)]

    def _pairs(self, grid, start, stop, low, high, which, need, often, columns: slice) -> tuple[np.ndarray, np.ndarray]:
        """Candidates: by latent cosine; items of under SHORT words, whose few words any neighbours outweigh, and all
        with ``exact``, by their words."""
        by_words = np.array([self.exact or len(self.items[i][1]) < SHORT for i in which])
        w, j = (np.zeros(0, np.int64),) * 2
        if not by_words.all():
            w, j = self._near(start, stop, columns)
            w, j = w[~by_words[j]], j[~by_words[j]]
        if by_words.any():
            cols = np.flatnonzero(by_words)
            w2, j2 = self._placed(grid, low, high, need[cols], often[:, cols])
            w, j = np.r_[w, w2], np.r_[j, cols[j2]]
        return w, j

    def _near(self, start: np.ndarray, stop: np.ndarray, columns: slice) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (passage, item) whose latent cosine reaches the bound."""
        dots = self.sums[stop, columns] - self.sums[start, columns]
        bound = self.cosine * np.sqrt(np.maximum(self.energy[stop] - self.energy[start], 1e-12))
        return np.nonzero(dots >= bound[:, None])

    @staticmethod
    def _placed(grid: np.ndarray, low: np.ndarray, high: np.ndarray, need: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (passage, item) of steps ``low`` to ``high`` with words of the item in as many places as it needs."""
        a, z = int(low[0]), int(high[-1])  # both rise from passage to passage
        places = np.zeros((z - a + 1, len(need)), np.int32)
        for r in range(BASE):
            places[1:] += often[grid[a:z, r]] > 0
        np.cumsum(places, axis=0, out=places)
        return np.nonzero(places[high - a] - places[low - a] >= need)

    @staticmethod
    def _enough(grid: np.ndarray, low: np.ndarray, high: np.ndarray, need: np.ndarray, often: np.ndarray, w: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs with as many words of the item as it needs, no term more often than in the item: that
        many at least are in any common subsequence that the check accepts."""
        if not len(w):
            return w, j
        some, at = np.unique(w, return_inverse=True)
        step = low[some][:, None] + np.arange(int((high - low).max()))
        words = np.where((step < high[some][:, None])[:, :, None], grid[np.minimum(step, len(grid) - 1)], 0).reshape(len(some), -1)
        words.sort(1)
        place = np.arange(words.shape[1])
        begins = np.ones(words.shape, bool)
        begins[:, 1:] = words[:, 1:] != words[:, :-1]
        again = np.minimum(place - np.maximum.accumulate(np.where(begins, place, 0), 1), 254).astype(np.uint8)  # earlier places of the term
        keep, each = np.zeros(len(w), bool), max(1, 500_000 // words.shape[1])
        for k in range(0, len(w), each):
            p = at[k: k + each]
            keep[k: k + each] = (again[p] < often[words[p], j[k: k + each, None]]).sum(1) >= need[j[k: k + each]]
        return w[keep], j[keep]

    def _score(self, passage: np.ndarray, item: int) -> float:
        energy = float((self.weights[passage] ** 2).sum(dtype=np.float64))
        return float(self.folded[passage].sum(0) @ self.latent[item]) / energy ** 0.5 if energy else 0.0

    def _check(self, found: dict, item: int, cosine: float, span: list[int]) -> None:
        words, answer = self.items[item][1], self.answers[item]
        if sum(map(set(span).__contains__, words)) < self._needed(item):
            return  # the common subsequence is shorter still
        if len(words) < SHORT:
            overlap = 1.0 if stands_in(words, span) else 0.0
        else:
            overlap = common_subsequence(words, span) / len(words)
        said = common_subsequence(answer, span) / len(answer) if answer and overlap >= self.paraphrase else 0.0
        if overlap >= self.verbatim or overlap >= self.paraphrase and said >= self.answer:
            found[item] = max(found.get(item, (-2.0, 0.0, 0.0)), (min(1.0, cosine), overlap, said), key=lambda v: (v[1], v[2], v[0]))


def indexes(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, verbatim: float, paraphrase: float, answer: float, rank: int, cosine: float, exact: bool):
    """An index for each block of items, one after another."""
    python_path(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).filter(F.col("item_id").isNotNull())
    blocks = -(-items.count() // BLOCK)
    done, todo = 0, [(blocks, b) for b in range(blocks)]
    while todo:
        of, b = todo.pop()
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(of)) == b)
        rows = sorted((r["item_id"], r["text"]) for r in part.collect())  # about BLOCK items
        vocabulary = sorted({w for _, t in rows for w in words_of(t)})
        if len(vocabulary) > (1 << 16) - 2 and len(rows) > 1:
            todo += [(2 * of, b), (2 * of, b + of)]
            continue
        if not vocabulary:
            continue
        number = {w: i + 1 for i, w in enumerate(vocabulary)}
        counts = docs.select("text").mapInArrow(_frequencies(number), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        df = np.zeros(len(number) + 1)
        df[counts.column("term").to_numpy()] = counts.column("n").to_numpy()
        idf = np.log((df[0] + 1) / (np.minimum(df, df[0]) + 1)) + 0.1
        idf[0] = 0.0
        vectors = singular_vectors(passages(part), number, idf, min(rank, len(number)))
        yield Index(rows, number, idf, vectors, verbatim, paraphrase, answer, cosine, exact)
        done += 1


OPTIONS = {"verbatim": 0.75, "paraphrase": 0.55, "answer": 0.8, "rank": RANK, "cosine": COSINE, "exact": False}


def _slices(batches, index: Index):
    """(rows, matches of each row) of slices of about 100,000 words."""
    terms = Terms(index.number)
    for batch in batches:
        at, held, size = 0, [], 0
        for i, t in enumerate(batch.column("text").to_pylist()):
            held.append(terms.encode(t))
            size += len(held[-1]) + BASE
            if size > 100_000 or i == batch.num_rows - 1:
                yield batch.slice(at, len(held)), index.matches(held)
                at, held, size = i + 1, [], 0


def _pairs(shared):
    def run(batches):
        for rows, found in _slices(batches, shared.value):
            out = [(d, *m) for d, ms in zip(rows.column("doc_id").to_pylist(), found) for m in ms]
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()))],
                                             ["doc_id", "item_id", "cosine", "overlap", "answer"])

    return run


def _unmatched(shared):
    def run(batches):
        for rows, found in _slices(batches, shared.value):
            yield rows.filter(pa.array([not m for m in found], pa.bool_()))

    return run


def search(docs: DataFrame, benchmark: DataFrame, **options: float) -> DataFrame:
    """``MATCHES`` rows: each document and benchmark item it leaks, with the best match's figures."""
    spark = docs.sparkSession
    found = spark.createDataFrame([], MATCHES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for index in indexes(spark, rows, benchmark, **{**OPTIONS, **options}):
        shared = spark.sparkContext.broadcast(index)  # a block of items
        found = found.unionByName(written(rows.mapInArrow(tidy(_pairs(shared)), MATCHES)))
        shared.unpersist()
    best = F.max(F.struct("overlap", "answer", "cosine")).alias("m")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.cosine", "m.overlap", "m.answer")


def clean(docs: DataFrame, benchmark: DataFrame, **options: float) -> DataFrame:
    """The rows of ``docs`` that leak no benchmark item, all columns kept. Between two blocks the rows that stay are written."""
    spark = docs.sparkSession
    rows, last = docs, None
    for index in indexes(spark, docs, benchmark, **{**OPTIONS, **options}):
        if last is not None:
            rows = written(rows)
            last.unpersist()
        last = spark.sparkContext.broadcast(index)
        rows = rows.mapInArrow(tidy(_unmatched(last)), docs.schema)
    return rows
