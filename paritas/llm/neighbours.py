"""Nearest neighbours by cosine: stable random projections, a kd-tree, a chi-square stop.

Rows with one vector form a class (its ``k + 1`` smallest ids stand for it: no answer needs
more), so copies cost one candidate. Unit vectors are projected by ``m`` Gaussian
directions: the squared projected distance of two vectors over their squared distance is a
chi-square variable with m degrees of freedom. A kd-tree over the projections, fitted on a
bounded sample, deals every class to a leaf; a leaf of many rows is split into blocks by
hash, so no group is unbounded.

Search. First each query visits its own leaf, which bounds the distance d of its k-th
neighbour. Then it visits the leaves whose box is nearer in the projection than
``d * sqrt(q)``, q the chi-square quantile of ``confidence``. Inside a block candidates come
in order of projected distance and are verified on the original vectors in small steps,
each of which may lower d; the scan stops as soon as the next projected distance fails the
chi-square test, that is, a nearer vector would have been met with that confidence. Both the
candidates and the queries of a leaf are dealt in blocks.

Defined cases: null vectors, vectors with null or non-finite parts, zero or empty vectors and
vectors of another length than the most common one take no part, as queries or candidates;
repeated rows count once; fewer candidates than k give all; an empty table gives no rows;
equal scores go to the smaller id; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paritas.llm.common import python_path, written

#: Rows of the sample that the tree is fitted on, rows a leaf aims at, most leaves, rows of a block of candidates or queries.
SAMPLE, LEAF, MAX_LEAVES, BLOCK = 32_768, 4096, 4096, 8192
STEP = 256


def chi_square_quantile(p: float, m: int) -> float:
    """Inverse of the chi-square distribution function for even m."""
    if m % 2:
        raise ValueError("m is even")

    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def usable(vec: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vec.isNotNull() & ~F.exists(vec, bad) & F.exists(vec, lambda x: x != 0)


def fit_tree(sample: np.ndarray, leaves: int) -> list[tuple[int, float]]:
    """Splits (dimension, value) of a complete tree in heap order, at medians of the widest spread."""
    splits: list[tuple[int, float]] = []
    groups = [sample]
    while len(groups) < leaves:
        below = []
        for g in groups:
            dim = int(np.argmax(g.var(0))) if len(g) else 0
            value = float(np.median(g[:, dim])) if len(g) else 0.0
            splits.append((dim, value))
            below += [g[g[:, dim] < value], g[g[:, dim] >= value]]
        groups = below
    return splits


def leaf_of(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    if splits:
        dims, values = (np.array(x) for x in zip(*splits))
        for _ in range((len(splits) + 1).bit_length() - 1):
            node = 2 * node + 1 + (points[np.arange(len(points)), dims[node]] >= values[node])
    return node - len(splits)


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(1, keepdims=True)
    x = x / top
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))


def _project(directions: np.ndarray):
    def run(batches):
        for b in batches:
            x = _unit(_matrix(b.column("vec"), len(directions))) if b.num_rows else np.zeros((0, len(directions)))
            yield pa.RecordBatch.from_arrays([*b.columns, _lists(x @ directions)], [*b.schema.names, "point"])

    return run


def _assign(splits, m: int):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf_of(_matrix(b.column("point"), m), splits), pa.int64())], [*b.schema.names, "leaf"])

    return run


def _visits(boxes, m: int, q: float):
    """The leaves, other than its own, that a query has still to visit."""
    def run(batches):
        leaf, lo, hi = boxes.value
        for b in batches:
            p, d, home = _matrix(b.column("point"), m), b.column("bound").to_numpy(), b.column("leaf").to_numpy()
            rows, to = [], []
            for i in range(b.num_rows):
                gap = np.maximum(0, np.maximum(lo - p[i], p[i] - hi))
                near = leaf[((gap * gap).sum(1) <= q * d[i] + 1e-9) & (leaf != home[i])]
                rows += [i] * len(near)
                to += near.tolist()
            t = pa.Table.from_batches([b]).select(["q1", "q2", "vec", "point", "copies", "bound"]).take(pa.array(rows, pa.int64()))
            for part in t.append_column("leaf", pa.array(to, pa.int64())).to_batches(max_chunksize=4096):
                yield part

    return run


def _search(k: int, m: int, q: float):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if candidates.num_rows and queries.num_rows:
            c, s = candidates.combine_chunks(), queries.combine_chunks()
            width = len(c.column("vec")[0])
            x, points = (_matrix(c.column(n).chunk(0), w) for n, w in (("vec", width), ("point", m)))
            unit, ids = _unit(x), c.column("ids").to_pylist()
            first = np.array([i[0] for i in ids])
            k1, k2 = c.column("k1").to_numpy(), c.column("k2").to_numpy()
            y, centres = (_matrix(s.column(n).chunk(0), w) for n, w in (("vec", width), ("point", m)))
            for i, (q1, q2, copies, bound) in enumerate(zip(*(s.column(n).to_pylist() for n in ("q1", "q2", "copies", "bound")))):
                yu = _unit(y[i:i + 1])[0]
                gap = points - centres[i]
                gap = (gap * gap).sum(1)
                order = np.flatnonzero(gap <= q * bound + 1e-9)
                order = order[np.argsort(gap[order], kind="stable")]
                want, near, found, apart = max(1, k - copies + 1), np.zeros(0), [], []
                for at in range(0, len(order), STEP):
                    part = order[at: at + STEP]
                    if gap[part[0]] > q * bound + 1e-9:
                        break  # a nearer vector would have been met before
                    d = unit[part] - yu
                    d = np.einsum("ij,ij->i", d, d)
                    found.append(part)
                    apart.append(d)
                    near = np.sort(np.r_[near, d[(k1[part] != q1) | (k2[part] != q2)]])[:want]
                    if len(near) == want:
                        bound = min(bound, float(near[-1]))
                if not found:
                    continue
                got, d = np.concatenate(found), np.concatenate(apart)
                if len(got) > k + 1:  # scores only of those that can be among the k + 1 best
                    got = got[d <= np.partition(d, k)[k] + 1e-9]
                dot = (x[got] * y[i]).sum(1)
                score = dot / (np.sqrt((x[got] * x[got]).sum(1)) * np.sqrt((y[i] * y[i]).sum()))
                for j in np.lexsort((first[got], -score))[: k + 1]:
                    for col, v in zip(out, (q1, q2, float(score[j]), ids[got[j]], bound)):
                        col.append(v)
        return pa.table([pa.array(col, t) for col, t in zip(out, (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.float64()))],
                        names=["q1", "q2", "score", "ids", "bound"])

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 5, m: int = 8, confidence: float = 0.99, seed: int = 7) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest found of each query among
    ``vectors(vec_id, embedding)``; ``is_query`` is a condition on ``vec_id``."""
    spark = vectors.sparkSession
    python_path(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec")).filter(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    sizes = rows.groupBy(F.size("vec").alias("w")).count().orderBy(F.desc("count"), "w").head(1)
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = sizes[0]["w"]
    keyed = rows.filter(F.size("vec") == width).withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit(1), "vec")})
    of_class = Window.partitionBy("k1", "k2").orderBy("vec_id")
    smallest = keyed.dropDuplicates(["vec_id", "k1", "k2"]).withColumn("n", F.row_number().over(of_class)).filter(F.col("n") <= k + 1)
    classes = smallest.groupBy("k1", "k2").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("vec_id")).alias("ids"))  # at most k + 1 ids
    directions = np.random.default_rng(seed).standard_normal((width, m))
    schema = f"k1 long, k2 long, vec {dict(classes.dtypes)['vec']}, ids array<long>, point array<double>"
    projected = written(classes.mapInArrow(_project(directions), schema))
    n = projected.count()
    sample = projected.select("point", "k1").orderBy(F.xxhash64("k1", "k2")).limit(SAMPLE).select("point").toArrow()
    leaves = min(MAX_LEAVES, 1 << max(0, math.ceil(math.log2(max(1, n / LEAF)))))
    splits = fit_tree(_matrix(sample.column("point").combine_chunks(), m), leaves)
    dealt = projected.mapInArrow(_assign(splits, m), schema + ", leaf long")
    bounds = [f(F.col("point")[i]).alias(f"{a}{i}") for i in range(m) for a, f in (("lo", F.min), ("hi", F.max))]
    per_leaf = dealt.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), *bounds).collect()  # at most MAX_LEAVES rows
    boxes = (np.array([r["leaf"] for r in per_leaf], np.int64), *(np.array([[r[f"{a}{i}"] for i in range(m)] for r in per_leaf]) for a in ("lo", "hi")))
    blocks = spark.createDataFrame([(r["leaf"], -(-r["n"] // BLOCK)) for r in per_leaf], "leaf long, blocks long")
    index = written(dealt.join(F.broadcast(blocks), "leaf").withColumn("block", F.pmod("k1", "blocks")).drop("blocks"))

    asking = keyed.filter(is_query).select("vec_id", F.col("k1").alias("q1"), F.col("k2").alias("q2")).distinct()
    queries = (index.join(asking.select(F.col("q1").alias("k1"), F.col("q2").alias("k2")).distinct(), ["k1", "k2"], "left_semi")
               .select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), "vec", "point", F.size("ids").cast("long").alias("copies"), "leaf"))
    q = chi_square_quantile(confidence, m)

    def probe(visits: DataFrame) -> DataFrame:
        """Rows (q1, q2, score, ids, bound) of visits to leaves: every block of candidates meets every block of queries."""
        visits = written(visits)
        load = visits.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("asks"))
        plan = F.broadcast(blocks.join(load, "leaf"))  # at most MAX_LEAVES rows
        left = index.join(plan, "leaf").withColumn("ask", F.explode(F.sequence(F.lit(0).cast("long"), F.col("asks") - 1))).drop("asks", "blocks")
        right = (visits.join(plan, "leaf").withColumn("ask", F.pmod("q1", "asks"))
                 .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("asks", "blocks"))
        return (left.groupBy("leaf", "block", "ask").cogroup(right.groupBy("leaf", "block", "ask"))
                .applyInArrow(_search(k, m, q), "q1 long, q2 long, score double, ids array<long>, bound double"))

    home = written(probe(queries.withColumn("bound", F.lit(1e9))))
    bounded = queries.join(home.groupBy("q1", "q2").agg(F.min("bound").alias("bound")), ["q1", "q2"])
    shared = spark.sparkContext.broadcast(boxes)
    away = bounded.select("q1", "q2", "vec", "point", "copies", "bound", "leaf").mapInArrow(
        _visits(shared, m, q), f"q1 long, q2 long, vec {dict(classes.dtypes)['vec']}, point array<double>, copies long, bound double, leaf long")
    found = home.unionByName(probe(away)).select("q1", "q2", "score", F.explode("ids").alias("vec_id"))
    best = found.withColumn("n", F.row_number().over(Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "vec_id"))).filter(F.col("n") <= k + 1).drop("n")
    own = asking.withColumnRenamed("vec_id", "query_id").join(best, ["q1", "q2"]).filter(F.col("vec_id") != F.col("query_id"))
    ranked = own.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
