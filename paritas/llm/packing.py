"""Best-fit packing after Martello-Toth dominance reduction.

Documents become pieces of at most ``capacity`` tokens; pieces are packed into as few
sequences as the method finds. Which lengths go together depends only on how many pieces
each length has, a table of at most ``capacity`` rows whatever the corpus, so the plan is
made on that histogram:

1. Reduction. A set of lengths is fixed for good when it dominates every other set that
   could hold the same piece (the larger side of each exchange covers what it replaces, so
   some best packing contains it): a piece no other fits with; a pair that fills a sequence
   exactly; the largest partner when no two partners fit; with at most two partners, the
   largest partner if it covers every pair, or the best pair if it contains the largest
   partner and fills the sequence.
2. The shrunk rest is packed best fit, longest first: whole groups of equally filled
   sequences take a length at once, so the work follows the number of lengths.

The plan is a list of intervals: pieces of a length with ranks in [lo, hi) go to sequences
``first + (rank - lo) // each``. Ranks are given without gathering a length in one task:
each task numbers its own pieces per length, and the counts per (task, length) give the
offsets. The numbered pieces are a written table, so a rerun cannot renumber them.

Defined cases: a null text is an empty text (one piece, the end id); repeated rows and ids
are packed as separate documents; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paritas.llm.common import python_path, tidy, written
from paritas.llm.tokens import encoder, gathered, in_slices

Runs = tuple[tuple[int, int], ...]  # (length, copies) in the order they stand in a sequence


def _reduce(count: list[int], cap: int) -> list[tuple[Runs, int]]:
    """Fix dominating sets; ``count`` keeps what is not fixed."""
    fixed: list[tuple[Runs, int]] = []

    def fix(*lengths: int) -> None:
        copies = {x: lengths.count(x) for x in lengths}
        bins = min(count[x] // c for x, c in copies.items())
        for x, c in copies.items():
            count[x] -= bins * c
        fixed.append((tuple(copies.items()), bins))

    for j in range(cap, (cap + 1) // 2 - 1, -1):  # full alone, or filled exactly by a partner
        if count[j] and (j == cap or count[cap - j] and (2 * j != cap or count[j] > 1)):
            fix(*((j,) if j == cap else (j, cap - j)))
    have = [x for x in range(1, cap + 1) if count[x]]
    changed = True
    while changed:
        changed = False
        for j in reversed(have):
            while count[j]:
                # The smallest partners, and the largest ones, of one piece of length j.
                least, room = [], cap - j
                for x in have:
                    least += [x] * min(3, count[x] - (x == j))
                    if len(least) >= 3:
                        break
                largest = next((x for x in reversed(have[: bisect.bisect_right(have, room)]) if count[x] - (x == j) > 0), 0)
                if not largest:
                    fix(j)
                elif sum(least[:2]) > room or len(least) < 2:
                    fix(j, largest)
                elif sum(least[:3]) > room or len(least) < 3:
                    a, b = _best_pair(have, count, j, room)
                    if largest >= a + b:
                        fix(j, largest)
                    elif a == largest and a + b == room:
                        fix(j, a, b)
                    else:
                        break
                else:
                    break
                changed = True
        have = [x for x in have if count[x]]
    return fixed


def _best_pair(have: list[int], count: list[int], j: int, room: int) -> tuple[int, int]:
    """The two partners (larger first) of one piece j with the largest sum that fits."""
    best = (0, 0)
    left = {x: count[x] - (x == j) for x in have if x <= room and count[x] - (x == j) > 0}
    keys = sorted(left)
    for a in reversed(keys):
        i = bisect.bisect_right(keys, min(a, room - a)) - 1
        while i >= 0 and keys[i] == a and left[a] < 2:
            i -= 1
        if i >= 0 and a + keys[i] > sum(best):
            best = (a, keys[i])
    return best


def _best_fit(count: list[int], cap: int) -> list[tuple[Runs, int]]:
    """Best fit, longest first, on groups of sequences that are filled alike."""
    groups: dict[int, list[tuple[Runs, int]]] = {}
    rooms: list[int] = []  # sorted rooms of open groups

    def put(room: int, runs: Runs, bins: int) -> None:
        if bins:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append((runs, bins))

    for x in range(cap, 0, -1):
        c = count[x]
        while c:
            i = bisect.bisect_left(rooms, x)
            if i < len(rooms):
                room = rooms[i]
                runs, bins = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(i)
            else:
                room, runs, bins = cap, (), c
            each = min(room // x, c)
            full = min(bins, c // each)
            put(room - each * x, runs + ((x, each),), full)
            c -= full * each
            if runs:
                put(room, runs, bins - full)
        count[x] = 0
    return [g for gs in groups.values() for g in gs]


def plan(counts: dict[int, int], cap: int) -> list[tuple[int, int, int, int, int, int]]:
    """Intervals (length, lo, hi, first sequence, offset, copies in a sequence) of all pieces."""
    count = [0] * (cap + 1)
    for x, c in counts.items():
        count[x] = c
    placed, intervals, first = [0] * (cap + 1), [], 0
    for runs, bins in _reduce(count, cap) + _best_fit(count, cap):
        at = 0
        for x, each in runs:
            intervals.append((x, placed[x], placed[x] + bins * each, first, at, each))
            placed[x] += bins * each
            at += x * each
        first += bins
    return intervals


def _pieces(path: str, end_id: int, cap: int):
    def run(batches):
        enc = encoder(path)
        for b in gathered(batches):
            ids = enc.encode_array(b.column("text"), end_id)
            n = np.diff(ids.offsets.to_numpy().astype(np.int64))
            count = (n + cap - 1) // cap
            row = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(row)) - (np.cumsum(count) - count)[row]
            first = (n - (count - 1) * cap)[row]
            length = np.where(piece == 0, first, cap)
            start = np.where(piece == 0, 0, first + (piece - 1) * cap)
            places = np.append(0, 4 * np.cumsum(length)).astype(np.int32)
            blobs = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(places), pa.py_buffer(ids.flatten().to_numpy().astype("<u4"))])
            yield from in_slices([pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), blobs],
                ["doc_id", "piece", "start", "length", "ids"])])

    return tidy(run)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids`` (little-endian unsigned 32-bit ids): whole documents,
    or pieces of ``capacity`` tokens of the longer ones, of which the first may be shorter."""
    python_path(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(_pieces(vocabulary, end_id, capacity), "doc_id long, piece int, start long, length long, ids binary"))


def _number(cap: int):
    def run(batches):
        seen, part = np.zeros(cap + 1, np.int64), TaskContext.get().partitionId()
        for b in batches:
            x = b.column("length").to_numpy()
            order = np.argsort(x, kind="stable")
            s = x[order]
            starts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, np.int64)
            sizes = np.diff(np.r_[starts, len(s)])
            rank = np.empty(len(s), np.int64)
            rank[order] = np.arange(len(s)) - np.repeat(starts, sizes) + np.repeat(seen[s[starts]], sizes)
            seen[s[starts]] += sizes
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(s), part, np.int32)), pa.array(rank)],
                                             [*b.schema.names, "_part", "_rank"])

    return run


def _place(intervals):
    def run(batches):
        iv = intervals.value
        width = int(iv[:, 2].max(initial=0)) + 1
        keys = iv[:, 0] * width + iv[:, 1]
        for b in batches:
            x, r = b.column("length").to_numpy(), b.column("_rank").to_numpy()
            i = iv[np.searchsorted(keys, x * width + r, side="right") - 1]
            k = r - i[:, 1]
            names = [n for n in b.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), pa.array(i[:, 3] + k // i[:, 5]), pa.array(i[:, 4] + k % i[:, 5] * x)],
                [*names, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Rows of ``pieces`` (a ``length`` from 1 to ``capacity`` each, any other columns) with the
    ``sequence_id`` and ``offset`` of their place. Sequences are gapless from offset 0."""
    spark = pieces.sparkSession
    python_path(spark)
    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    numbered = written(pieces.mapInArrow(_number(capacity), f"{schema}, _part int, _rank long"))
    per_task = written(numbered.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    intervals = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 6)
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("_part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    ranked = (numbered.join(base, ["_part", "length"]).withColumn("_rank", F.col("_rank") + F.col("_base"))
              .select(*pieces.columns, "_rank"))
    shared = spark.sparkContext.broadcast(intervals)  # bounded by the number of lengths, not by the corpus
    return ranked.mapInArrow(_place(shared), f"{schema}, sequence_id long, offset long")
