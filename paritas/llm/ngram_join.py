"""N-gram Jaccard join with parity sketches.

A document's set holds the 64-bit hashes of its distinct word shingles. Documents link when
``100 * |A and B| >= percent * |A or B|``, which bounds their symmetric difference by
``d = (100 - percent)(|A| + |B|) / (100 + percent)``.

Sketch. Sets are dealt to geometric size bands. In a band a sketch has c > d chunks of 64 bits;
every shingle flips one bit of one chunk, so the Hamming distance of two sketches never
exceeds the symmetric difference, and at least c - d chunks of a linked pair hold the same shingles.
A key is the 64-bit hash of a chunk's shingles: of the bits alone, few are set, so unlike documents would share
them by chance, in numbers that grow with the square of the documents.
All chunks (place and shingles) stand in one fixed order, those with more bits first, as many
documents share one with few shingles. A document lists its first d + 1 chunks, d taken from its own
size and the largest partner it can have in the band: two sketches that agree in c - d chunks share one
among these. A document is listed in its own band and in the next one when a document there may
link to it.

Join. Equal chunks meet by key. 1. Every member of a key is paired with the key's least
node; the pairs (linear in the members) pass the bound of a small sketch (two to four bits a shingle) and are
verified on the sets: one pair of each node first, then those that components of the links
found so far leave apart. Components of all these links label the nodes.
2. Members of a key that still differ
in label are compared with each other in blocks of bounded size, block against block: the
sketch's bound first, then the sets, and only links that join two labels are emitted. A key
with two members needs no second step, and a group of copies is resolved by the first. So
no step emits all pairs of a group, and no pair that may link is left out.

Documents with one set are one node (its hash); copies cost one node. The set's 64-bit hash
stands for the set: two different sets of N share it with odds of about N^2 / 3.7e19.

Defined cases: a null or empty text has no set and links with nothing; a text of fewer words
than a shingle is one shingle; a null ``doc_id`` links with nothing and has a null
component; rows that repeat a ``doc_id`` are one document with several texts, whose groups
are one component, while ``stays`` is decided in each text's own group; an empty
table gives no rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from paritas.llm.common import free_name, python_path, tidy, written
from paritas.llm.components import components

#: Shingles of a block of the second step (8 bytes each), and words a worker remembers.
BLOCK_SHINGLES, WORDS = 2_000_000, 100_000
#: Places of the broadcast bitmap that spares rereading texts nobody asks for (a prime; 4 MB), and least bits of the small sketch.
PLACES, SMALL = 33_554_393, 512
_HASHES: dict[bytes, bytes] = {}
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    new = set(words).difference(_HASHES)
    if len(_HASHES) > WORDS:
        _HASHES.clear()
        new = set(words)
    import xxhash

    _HASHES.update((w, xxhash.xxh3_64_digest(w)) for w in new)
    return np.frombuffer(b"".join(map(_HASHES.__getitem__, words)), np.uint64)


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h, width = _word_hashes(words), min(k, len(words))
    n = len(h) - width + 1
    acc = np.full(n, width, np.uint64)
    for i in range(width):
        acc = acc * _U(0x9E3779B97F4A7C15) + h[i: n + i]
    return np.unique(mix(acc))


def node_of(grams: np.ndarray) -> int:
    """Signed 64-bit hash of a set."""
    x = np.array([grams.sum(), np.bitwise_xor.reduce(mix(grams + _U(0x632BE59BD9B4E019))), len(grams)], np.uint64)
    return int(mix(x * np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)).sum(keepdims=True).view(np.int64)[0])


class Bands:
    """Size bands with the chunks of each."""

    def __init__(self, percent: int, ratio: float = 2.0):
        self.percent, self.edges = percent, [1]
        while self.edges[-1] < 1 << 32:
            self.edges.append(max(self.edges[-1] + 1, math.ceil(self.edges[-1] * ratio)))
        self.chunks = [self._chunks(hi - 1) for hi in self.edges[1:]]

    def apart(self, sizes):
        """Largest symmetric difference of two linked sets with that sum of sizes."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def _chunks(self, most: int) -> int:
        d = self.apart(2 * most)
        if not d:
            return 0  # links are equal sets only
        e = 0
        while e <= d:
            c = d + 1 + e
            mean = most / c
            few = c * math.exp(-mean) * (1 + mean)  # chunks with fewer than two shingles, about
            if e >= few + 2 * math.sqrt(few):
                break
            e += max(1, e // 16)
        return d + 1 + e

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.edges, n, side="right")) - 1

    def listed(self, n: int) -> range:
        """Bands in which a set of n shingles is listed."""
        return range(self.of(n), self.of(n * 100 // self.percent) + 1)

    def _dealt(self, grams: np.ndarray, values: np.ndarray, band: int) -> np.ndarray:
        """Exclusive-or of the values of the (sorted) shingles in each chunk."""
        c = self.chunks[band]
        out = np.zeros(c, np.uint64)
        if c and len(grams):
            chunk = ((grams >> _U(32)) * _U(c)) >> _U(32)
            first = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]])
            out[chunk[first].astype(np.int64)] = np.bitwise_xor.reduceat(values, first)
        return out

    def sketch(self, grams: np.ndarray, band: int) -> np.ndarray:
        return self._dealt(grams, _U(1) << (grams & _U(63)), band)

    def contents(self, grams: np.ndarray, band: int) -> np.ndarray:
        """Hash of the shingles in each chunk."""
        return self._dealt(grams, mix(grams + _U(0x8CB92BA72F3D8DD7)), band)

    def keys(self, grams: np.ndarray) -> np.ndarray:
        """Join keys (signed 64-bit hashes of band, chunk and its shingles) of a set."""
        out, n = [], len(grams)
        for band in self.listed(n):
            words, contents = self.sketch(grams, band), self.contents(grams, band)
            if len(words):
                keys = self.key(contents, np.arange(len(words)), band)
                out.append(keys[self.kept(words[None], contents[None], np.array([n]), band)[0]])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def key(self, contents: np.ndarray, chunk: np.ndarray, band: int) -> np.ndarray:
        return mix(contents ^ mix(chunk.astype(np.uint64) + _U(int(band) << 40))).view(np.int64)

    def kept(self, words: np.ndarray, contents: np.ndarray, n: np.ndarray, band: int) -> np.ndarray:
        """Which chunks of each sketch (a row, of a set of n shingles) are listed: the first d + 1,
        those with more bits before those with fewer, then by the hash of the key."""
        d = self.apart(n + np.minimum(self.edges[band + 1] - 1, n * 100 // self.percent))
        order = (_U(64) - np.bitwise_count(words).astype(np.uint64)) << _U(57) | self.key(contents, np.arange(words.shape[1]), band).view(np.uint64) >> _U(7)
        rank = np.argsort(np.argsort(order, axis=1, kind="stable"), axis=1, kind="stable")
        return (rank <= d[:, None]) & (d > 0)[:, None]

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether two sets link, exactly."""
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
        return 100 * both >= self.percent * (len(a) + len(b) - both)


def _sets(k: int):
    def run(batches):
        for b in batches:
            got = [shingles(t, k) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(g) for g in got], pa.int64()), pa.array([node_of(g) if len(g) else None for g in got], pa.int64()),
                 pa.array([small_sketch(g) if len(g) else None for g in got], pa.binary())], ["doc_id", "n", "node", "small"])

    return run


def with_nodes(docs: DataFrame, words: int, name: str) -> DataFrame:
    """``docs`` with the node of each row's text in a column ``name`` (null without a set)."""
    def run(batches):
        for b in batches:
            got = [shingles(t, words) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([node_of(g) if len(g) else None for g in got], pa.int64())], [*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def _keys(k: int, bands: Bands, bitmap):
    def run(batches):
        for _, texts in _asked(batches, bitmap):
            got = [g for t in texts if len(g := shingles(t, k))]
            keys = [bands.keys(g) for g in got]
            each = [len(x) for x in keys]
            nodes, sizes = (np.repeat(np.array(x, np.int64), each) for x in ([node_of(g) for g in got], [len(g) for g in got]))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate([np.zeros(0, np.int64), *keys]), nodes, sizes)], ["key", "node", "n"])

    return run


def small_sketch(grams: np.ndarray) -> bytes:
    """One parity sketch of a power of two of bits, two to four a shingle and ``SMALL`` at least; ``fold`` makes it shorter."""
    bits = max(SMALL, 2 << (len(grams) - 1).bit_length())
    return np.packbits((np.bincount(((grams >> _U(9)) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def fold(sketches: np.ndarray, width: int) -> np.ndarray:
    """Small sketches (rows of 64-bit words) as they are with ``width`` words."""
    while sketches.shape[1] > width:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def _bitmap(ids: DataFrame) -> np.ndarray:
    """Bitmap of the ids modulo ``PLACES``: at most PLACES / 64 words, whatever the number of ids."""
    place = F.pmod("doc_id", F.lit(PLACES))
    words = (ids.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(doc_id, {PLACES}) & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    out = np.zeros(PLACES // 64 + 1, np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out


def _asked(batches, bitmap):
    for batch in batches:
        at = np.mod(batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64), PLACES)
        b = batch.filter(pa.array((bitmap.value[at >> 6] >> (at & 63)) & 1 == 1))
        for k in range(0, b.num_rows, 64):
            part = b.slice(k, 64)
            yield part.column("doc_id"), part.column("text").to_pylist()


def _sketched(k: int, bands: Bands, bitmap):
    def run(batches):
        for ids, texts in _asked(batches, bitmap):
            got = [shingles(t, k) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([node_of(g) if len(g) else None for g in got], pa.int64()),
                 pa.array([[bands.sketch(g, x).tobytes() + bands.contents(g, x).tobytes() for x in bands.listed(len(g))] if len(g) else [] for g in got], pa.list_(pa.binary()))],
                ["doc_id", "node", "sketches"])

    return run


def _grams(k: int, bitmap):
    def run(batches):
        for ids, texts in _asked(batches, bitmap):
            got = [shingles(t, k) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([node_of(g) if len(g) else None for g in got], pa.int64()), pa.array([g.tobytes() for g in got], pa.binary())], ["doc_id", "node", "grams"])

    return run


def _reread(texts: DataFrame, firsts: DataFrame, nodes: DataFrame, work, schema: str) -> DataFrame:
    """What ``work`` makes of the texts of ``nodes``, one row per node."""
    wanted = written(firsts.join(nodes.select("node").distinct(), "node", "left_semi").select("doc_id", "node"))
    bitmap = texts.sparkSession.sparkContext.broadcast(_bitmap(wanted))
    made = written(texts.mapInArrow(tidy(work(bitmap)), schema).join(wanted, ["doc_id", "node"], "left_semi").drop("doc_id"))
    if made.count() > made.select("node").distinct().count():  # a repeated doc_id
        made = written(made.dropDuplicates(["node"]))
    return made


def _near_small(percent: int):
    """Keeps pairs whose sizes and small sketches allow a link."""
    def run(batches):
        for b in batches:
            na, nb = b.column("na").to_numpy(), b.column("nb").to_numpy()
            sa, sb = b.column("sa").to_pylist(), b.column("sb").to_pylist()
            wide = np.array([(len(x) // 8, len(y) // 8) for x, y in zip(sa, sb)]).reshape(-1, 2)
            apart = np.zeros(len(sa), np.int64)
            for wa, wb in np.unique(wide, axis=0).tolist():
                at = np.flatnonzero((wide == (wa, wb)).all(1))
                x, y = (fold(np.frombuffer(b"".join(s[i] for i in at), np.uint64).reshape(-1, w), min(wa, wb)) for s, w in ((sa, wa), (sb, wb)))
                apart[at] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
            ok = (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & ((100 + percent) * apart <= (100 - percent) * (na + nb))
            yield b.select(["a", "b"]).filter(pa.array(ok))

    return run


def _verify(bands: Bands):
    def run(batches):
        for b in batches:
            ok = [bands.linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(b.column("ga").to_pylist(), b.column("gb").to_pylist())]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


class Group:
    """Members ``(node, label, n, sketches, ...)`` of a task, smallest set first."""

    def __init__(self, bands: Bands, rows: list[tuple]):
        self.bands, self.rows = bands, sorted({r[0]: r for r in rows}.values(), key=lambda r: (r[2], r[0]))
        self.label = np.array([r[1] for r in self.rows], np.int64)
        self.n = np.array([r[2] for r in self.rows], np.int64)

    def near(self):
        """(band, sketches and their contents, place of i, places of the smaller members of another label whose sketch
        allows a link with i, members at the places) for each i that has some."""
        p, n = self.bands.percent, self.n
        own = np.array([self.bands.of(x) for x in n])
        for band in np.unique(own):
            listed = np.flatnonzero([own[i] <= band < own[i] + len(self.rows[i][3]) for i in range(len(own))])
            both = np.stack([np.frombuffer(self.rows[i][3][band - own[i]], np.uint64) for i in listed])
            if not both.shape[1]:
                continue
            words, contents = np.split(both, 2, axis=1)
            for k in np.flatnonzero(own[listed] == band):
                i = listed[k]
                first = np.searchsorted(n[listed[:k]] * 100, p * n[i])
                can = np.flatnonzero(self.label[listed[first:k]] != self.label[i]) + first
                apart = np.bitwise_count(words[can] ^ words[k]).sum(1, dtype=np.int64)
                can = can[(100 + p) * apart <= (100 - p) * (n[listed[can]] + n[i])]
                if len(can):
                    yield band, (words, contents), k, can, listed

    def close(self) -> list[int]:
        """Members with a member of another label whose small sketch allows a link."""
        p, n, out = self.bands.percent, self.n, np.zeros(len(self.n), bool)
        words = [np.frombuffer(r[3], np.uint64)[None] for r in self.rows]
        width = min(x.shape[1] for x in words)  # a key's sizes are of one band: at most twice as wide
        words = np.concatenate([fold(x, width) for x in words])
        for i in range(1, len(n)):
            first = np.searchsorted(n[:i] * 100, p * n[i])
            can = np.flatnonzero(self.label[first:i] != self.label[i]) + first
            apart = np.bitwise_count(words[can] ^ words[i]).sum(1, dtype=np.int64)
            can = can[(100 + p) * apart <= (100 - p) * (n[can] + n[i])]
            out[can] = True
            out[i] |= len(can) > 0
        return np.flatnonzero(out).tolist()

    def flagged(self, key: int) -> list[int]:
        """Members in a near pair whose first common key is this one; so a pair counts in one key."""
        out: set[int] = set()
        last = None
        for band, (words, contents), k, can, listed in self.near():
            if band != last:
                last, kept = band, self.bands.kept(words, contents, self.n[listed], band)
            common = (contents[can] == contents[k]) & kept[can] & kept[k]
            first = common.argmax(1)
            here = can[common.any(1) & (self.bands.key(contents[k, first], first, band) == key)]
            if len(here):
                out.update(listed[here].tolist(), [int(listed[k])])
        return sorted(out)

    def links(self) -> list[tuple[int, int]]:
        """Verified links that join labels."""
        found, grams = [], lambda i: np.frombuffer(self.rows[i][4], np.uint64)
        for _, _, k, can, listed in self.near():
            i = listed[k]
            for j in listed[can]:
                if self.label[j] != self.label[i] and self.bands.linked(grams(j), grams(i)):
                    found.append((self.rows[j][0], self.rows[i][0]))
                    self.label[self.label == self.label[j]] = self.label[i]
        return found


def _groups(batches, columns: list[str]):
    """((key, task), rows) of rows sorted by both, and None after each batch; a group is two blocks."""
    now, rows = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            b = batch.slice(at, 256)
            for key, task, *row in zip(*(b.column(n).to_pylist() for n in ("key", "task", *columns))):
                if now != (key, task):
                    if rows:
                        yield now, rows
                    now, rows = (key, task), []
                rows.append(row)
        yield None
    if rows:
        yield now, rows
    yield None


def _flag_groups(bands: Bands, column: str):
    """Members that stay after a look at the small sketches, or at the sketches."""
    def run(batches):
        out: list[tuple] = []
        for got in _groups(batches, ["node", "label", "n", column]):
            if got:
                (key, task), rows = got
                g = Group(bands, rows)
                out += [(key, task, g.rows[i][0], g.rows[i][1]) for i in (g.close() if column == "small" else g.flagged(key))]
            else:
                cols = list(zip(*out)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["key", "task", "node", "label"])
                out = []

    return run


def _link_groups(bands: Bands):
    def run(batches):
        out: list[tuple] = []
        for got in _groups(batches, ["node", "label", "n", "sketches", "grams"]):
            if got:
                out += Group(bands, got[1]).links()
            else:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])
                out = []

    return run


def _unresolved(members: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """``key, task, node, label`` of the members to compare: those of a key, without its least node,
    that still differ in label; every block meets every block but those of the main label each other.
    A member whose neighbours by size are too small or too large for a link has no partner in its key."""
    by_key = Window.partitionBy("key")
    by_size = by_key.orderBy("n")
    rest = (members.filter(F.col("node") != F.col("lo")).select("key", "node", "n")
            .withColumns({"under": F.lag("n").over(by_size), "over": F.lead("n").over(by_size)})
            .filter((100 * F.col("under") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("over"))).drop("under", "over")
            .join(roots, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root"))
    rest = rest.withColumns({"l0": F.min("label").over(by_key), "l1": F.max("label").over(by_key)}).filter(F.col("l0") < F.col("l1"))
    rest = rest.withColumn("main", F.col("label") == F.col("l0"))
    for name, side in (("mains", F.col("main")), ("others", ~F.col("main"))):
        rest = rest.withColumn(name, F.ceil(F.sum(F.when(side, F.col("n")).otherwise(0)).over(by_key) / F.lit(BLOCK_SHINGLES)))
    h = F.xxhash64("node")
    other = F.pmod(h, "others")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    tasks = F.when(F.col("main"), F.transform(upto(F.col("others")), lambda o: F.concat(F.lit("m"), F.pmod(h, "mains"), F.lit("o"), o))).otherwise(F.concat(
        F.transform(upto(F.col("mains")), lambda m: F.concat(F.lit("m"), m, F.lit("o"), other)),
        F.transform(upto(F.col("others")), lambda o: F.concat(F.lit("o"), F.least(o, other), F.lit("o"), F.greatest(o, other)))))
    return rest.select("key", F.explode(tasks).alias("task"), "node", "label")


def join(docs: DataFrame, words: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Links between different sets and the documents:
    (``a, b`` nodes of verified links, enough to connect every component;
    ``doc_id, n_shingles, node, component_id, stays``, one row per row of ``docs``; ``stays`` is
    true for the least ``doc_id, node`` of a group of linked texts and for rows that link with nothing)."""
    spark = docs.sparkSession
    python_path(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bands = Bands(percent)
    sets = written(texts.mapInArrow(tidy(_sets(words)), "doc_id long, n long, node long, small binary"))
    nodes = written(sets.filter(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
                    .groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("small").alias("small")))
    firsts = nodes.select("node", "doc_id")

    by_key = Window.partitionBy("key")
    # only rows whose id stands for a node list its keys, so copies list none (ids that share a place of the bitmap may)
    named = spark.sparkContext.broadcast(_bitmap(firsts))
    keys = texts.filter(F.col("doc_id").isNotNull()).mapInArrow(tidy(_keys(words, bands, named)), "key long, node long, n long")
    members = written(keys.withColumns({"least": F.min(F.struct("node", "n")).over(by_key), "hi": F.max("node").over(by_key)})
                      .filter(F.col("least.node") < F.col("hi")).select("key", "node", "n", F.col("least.node").alias("lo"), F.col("least.n").alias("lo_n")).distinct())
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("node"))
    sketches_of = lambda some: _reread(texts, firsts, some, lambda m: _sketched(words, bands, m), "doc_id long, node long, sketches array<binary>")
    grams_of = lambda some: _reread(texts, firsts, some, lambda m: _grams(words, m), "doc_id long, node long, grams binary")

    def sides(pairs: DataFrame, table: DataFrame, **columns: str) -> DataFrame:
        for side in "ab":
            pairs = pairs.join(table.select(F.col("node").alias(side), *(F.col(c).alias(x + side) for x, c in columns.items())), side)
        return pairs

    def verified(pairs: DataFrame) -> DataFrame:
        return written(sides(pairs, grams_of(ends(pairs)), g="grams").mapInArrow(tidy(_verify(bands)), "a long, b long"))

    stars = members.filter(F.col("node") != F.col("lo")).select(F.col("lo").alias("a"), F.col("node").alias("b"), F.col("lo_n").alias("na"), F.col("n").alias("nb"))
    stars = stars.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).distinct()  # before their sketches are moved
    near = written(sides(stars, nodes, s="small").mapInArrow(tidy(_near_small(percent)), "a long, b long"))
    links = verified(written(near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")))
    roots = components(links)
    for side in "ab":  # the pairs that these links leave apart
        near = near.join(roots.select(F.col("node").alias(side), F.col("root").alias("r" + side)), side, "left")
    apart = F.coalesce("ra", "a") != F.coalesce("rb", "b")
    links = written(links.unionByName(verified(written(near.filter(apart).select("a", "b")))))
    roots = components(links)

    def look(rest: DataFrame, work, *columns: str, schema: str = "key long, task string, node long, label long") -> DataFrame:
        rows = rest.select("key", "task", "node", "label", "n", *columns).repartition("key", "task").sortWithinPartitions("key", "task")
        return written(rows.mapInArrow(tidy(work), schema))

    rest = look(_unresolved(members, roots, percent).join(nodes.select("node", "n", "small"), "node"), _flag_groups(bands, "small"), "small")
    sketches, sizes = sketches_of(rest), nodes.select("node", "n")
    rest = look(rest.join(sizes, "node").join(sketches, "node"), _flag_groups(bands, "sketches"), "sketches")
    more = look(rest.join(sizes, "node").join(sketches, "node").join(grams_of(rest), "node"), _link_groups(bands), "sketches", "grams", schema="a long, b long")
    links = written(links.unionByName(more))
    roots = components(links)

    def named(roots: DataFrame) -> DataFrame:
        labels = firsts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = labels.groupBy("root").agg(F.min(F.struct("doc_id", "node")).alias("least"))
        return labels.join(least, "root").select("node", "least", F.col("least.doc_id").alias("component_id"))

    names = named(roots)
    several = written(sets.filter(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
                      .groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z").select("doc_id", "a"))
    if not several.isEmpty():  # documents with different texts join the groups of these
        same = sets.join(several, "doc_id").filter(F.col("node") != F.col("a")).select("a", F.col("node").alias("b")).distinct()
        names = names.drop("component_id").join(named(components(links.unionByName(same))).drop("least"), "node")
    least = (F.col("doc_id") == F.col("least.doc_id")) & (F.col("node") == F.col("least.node"))
    documents = (sets.join(names, "node", "left")
                 .select("doc_id", F.col("n").alias("n_shingles"), "node",
                         F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
                         F.when(F.col("doc_id").isNotNull() & F.col("node").isNotNull(), least).otherwise(F.lit(True)).alias("stays")))
    return links, documents


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns kept, without near duplicates: of each group of linked texts the row with
    the least id stays. Equal rows (id and text) count as one document and one stays; rows that share an id
    with different texts are each decided in their own text's group; rows without an id or without words stay."""
    _, found = join(docs, words=words, percent=percent)
    found = written(found.select("doc_id", "node", "stays"))
    drop = written(found.filter(~F.col("stays")).select("doc_id", "node").distinct())
    again = found.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if again.isEmpty():
        return docs.join(drop, "doc_id", "left_anti").select(docs.columns)
    again = written(again)
    node, text = free_name("_node", docs.columns), free_name("_text", docs.columns)
    once = docs.join(again, "doc_id", "left_anti").join(drop.select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    rows = with_nodes(docs.join(again, "doc_id", "left_semi").select(docs.columns), words, node)
    rows = rows.join(drop.withColumnRenamed("node", node), ["doc_id", node], "left_anti").withColumn(text, F.when(F.col(node).isNull(), F.col("text")))
    return once.unionByName(rows.dropDuplicates(["doc_id", node, text]).select(docs.columns))
