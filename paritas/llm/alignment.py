"""Cross-tokenizer alignment as an Arrow pipeline.

Both tokenizers cut the same bytes (a space and the text). A block of documents is two list
columns of token ids; all steps work on whole columns:

1. Flatten the lists, with the parent index (the document) of each token.
2. Segmented cumulative sum of the tokens' byte lengths: the end of each token inside its document.
3. Acero hash join of both sides on (document, end): the ends where both tokenizers end, which cut a document into groups.
4. Links. Both sides partition the document's bytes, so the pieces between neighbouring ends
   of either side are exactly the overlaps, one for each pair of tokens that share a byte.
5. ``Table.group_by`` on the id pairs: the block's partial counts, which Spark sums up over all blocks.

How it runs: a block (``BLOCK_CHARS`` characters of whole documents, so one longer document is a block
by itself) becomes one written row: what concerns its documents, its different pairs with
counts, and its links as positions in that list of pairs, packed: the links are most of a row, and rows
that are large for the JVM's heap cost it far more than their bytes. The partial counts, one row per
block and pair, are summed per pair; a pair that stands everywhere costs one row a block.
The counts go back to the blocks by joining on the pair and grouping by block, so neither
vocabulary nor pairs are broadcast; a block's links meet their counts in one task.

Encoding: words go through the libraries, of the byte-level side mostly through ``tiktoken`` with
the same file's vocabulary (the same ids, tested). Both vocabularies start a new token at a single space between two characters that
are no white space (checked for the piece vocabulary when it is loaded, see tokens.py for
the other), so each such word is encoded once by the libraries and remembered by the
worker, up to ``WORDS`` words. That is a cache only: alignment sees whole documents.

Defined cases: null and empty texts, and texts whose tokens of either side do not spell a
space and the text (U+2581, which the piece vocabulary takes for a space), have no tokens: zeros and
an empty ``groups_sha256``; a null ``doc_id`` stays null and repeated rows stay rows of their
own, which count as often as they stand there; texts are read whole; an empty table gives no rows; other columns are ignored,
whatever their names; ties for a B id's highest count are all best.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import python_path, tidy, trim, written

#: Characters of a block, words a worker remembers, and bits of a B id inside a pair.
BLOCK_CHARS, WORDS, B_BITS = 500_000, 150_000, 24
#: Blocks of a written file (Spark decodes up to 4,096 rows of a file at once), and the codec of packed links.
FILE_BLOCKS, CODEC = 64, "zstd"
#: Fixed value: the split pattern of byte-level BPE. The two libraries' tables of letters may differ in
#: age, so only words of characters below PLAIN (settled long ago) go to the faster one.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = "\u0250"
BLOCKS = ("block long, doc_ids array<long>, n_a array<int>, n_b array<int>, n_groups array<int>, n_links array<int>, groups array<string>, "
          "pairs array<long>, counts array<long>, links binary")
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

_SPLIT = re.compile(r"(?<=\S) (?=\S)")
_CAREFUL = re.compile(r"\s\s|^\s|\s$")
SPACE = "▁"


def _byte_of() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1 stands for itself, the other bytes follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def _ranked(path: str, byte_of: dict[str, int]):
    """The vocabulary of a byte-level BPE file as ``tiktoken`` ranks, which encode several times faster; None
    when its merges are not in the order of their ids or its split pattern is not the usual one."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    model, vocabulary = made["model"], made["model"]["vocab"]
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    split = made["pre_tokenizer"] or {}
    if (made["normalizer"], split.get("type"), split.get("add_prefix_space"), split.get("use_regex", True)) != (None, "ByteLevel", False, True):
        return None
    if [vocabulary.get(m) for m in merges] != list(range(256, 256 + len(merges))) or len(vocabulary) - len(made["added_tokens"]) > 256 + len(merges):
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Tokens:
    """Ids of words by both tokenizers, remembered as two list columns."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of = _byte_of()
        vocabulary = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes(byte_of[c] for c in vocabulary[i]) if all(c in byte_of for c in vocabulary.get(i, "\0")) else b"" for i in range(max(vocabulary) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("the piece vocabulary has a space inside a piece: words cannot be encoded by themselves")
        self.b_bytes = [b"" if self.b.is_control(i) or self.b.is_unknown(i) else bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.ranked = _ranked(path_a, byte_of)
        self.a_size, self.b_size = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = (pa.array([str(i) for i in range(len(v))]) for v in (self.a_bytes, self.b_bytes))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.lists: list[tuple[pa.ListArray, pa.ListArray]] = []
        self.sound: list[np.ndarray] = []

    @staticmethod
    def words(text: str) -> list[str]:
        """The words whose encodings, each with a space before it, are that of the text with a space before it."""
        return _SPLIT.split(text) if _CAREFUL.search(text) else text.split(" ")

    def _learn(self, new: list[str]) -> None:
        a = [self.ranked.encode_ordinary(" " + w) if self.ranked and (w.isascii() or max(w) < PLAIN) else None for w in new]
        rest = [i for i, ids in enumerate(a) if ids is None]
        for i, e in zip(rest, self.a.encode_batch_fast([" " + new[i] for i in rest], add_special_tokens=False)):
            a[i] = e.ids
        b = self.b.encode(new, num_threads=1)
        spell = lambda of, ids: b"".join(map(of.__getitem__, ids))
        self.sound.append(np.array([spell(self.a_bytes, x) == spell(self.b_bytes, y) == f" {w}".encode() for w, x, y in zip(new, a, b)], bool))
        kind = pa.list_(pa.int32())
        self.lists.append((pa.array(a, kind), pa.array(b, kind)))

    def encode(self, texts: list[str | None]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of each text's tokens by A and by B; none where the texts have no tokens."""
        if len(self.known) > WORDS:
            self.forget()
        known, documents, new = self.known, [], []
        for t in texts:
            words = self.words(t) if t else []
            at = list(map(known.get, words))
            if None in at:
                for i, x in enumerate(at):
                    if x is None:
                        w = words[i]
                        at[i] = known.get(w)
                        if at[i] is None:
                            at[i] = known[w] = len(known)
                            new.append(w)
            documents.append(np.array(at, np.int32))
        if new:
            self._learn(new)
            if len(self.lists) > 64:
                self.lists = [tuple(pa.concat_arrays(x) for x in zip(*self.lists))]
                self.sound = [np.concatenate(self.sound)]
        if not self.lists:
            return (_lists(np.zeros(len(texts) + 1, np.int32), pa.array([], pa.int32())),) * 2
        sound = np.concatenate(self.sound)
        documents = [d if sound[d].all() else d[:0] for d in documents]
        flat = np.concatenate(documents)
        ends = np.concatenate([[0], np.cumsum([len(d) for d in documents])])
        out = []
        for side in zip(*self.lists):
            of_words = pa.concat_arrays(side).take(pa.array(flat))
            out.append(_lists(of_words.offsets.to_numpy()[ends], of_words.flatten()))
        return tuple(out)


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _ends(lists: pa.ListArray, size: np.ndarray, side: str) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """(document, end, place) of each token, its id, and the ends in the block's bytes, one document after the other."""
    ids = pc.list_flatten(lists)
    parent = pc.list_parent_indices(lists)
    whole = pc.cumulative_sum(pa.array(size[ids.to_numpy()])).to_numpy()
    first = lists.offsets.to_numpy()[:-1]
    before = np.concatenate([[0], whole])[first]  # bytes of the block before each document
    table = pa.table({"document": parent, "end": pa.array(whole - before[parent.to_numpy()]), side: pa.array(np.arange(len(ids), dtype=np.int64))})
    return table, ids.to_numpy(), whole


def _joined_ids(ids: np.ndarray, text: pa.Array, cuts: np.ndarray) -> pa.Array:
    return pc.binary_join(_lists(cuts, text.take(pa.array(ids))), ",")


def align(a: pa.ListArray, b: pa.ListArray, a_size: np.ndarray, b_size: np.ndarray, a_text: pa.Array, b_text: pa.Array) -> dict:
    """Groups and links of documents, each the list of its token ids by A and by B, which spell the same bytes."""
    n = len(a)
    left, a_ids, a_ends = _ends(a, a_size, "a")
    right, b_ids, b_ends = _ends(b, b_size, "b")
    common = left.join(right, ["document", "end"], join_type="inner", use_threads=False).sort_by("a")
    a_cut, b_cut = (np.concatenate([[0], common.column(s).to_numpy() + 1]) for s in "ab")
    n_groups = np.bincount(common.column("document").to_numpy(), minlength=n)
    group = pc.binary_join_element_wise(_joined_ids(a_ids, a_text, a_cut), _joined_ids(b_ids, b_text, b_cut), "|")
    groups = pc.binary_join(_lists(np.concatenate([[0], np.cumsum(n_groups)]), group), ";")
    ends = np.concatenate([a_ends, b_ends])
    ends.sort(kind="stable")
    ends = ends[np.concatenate([ends[1:] != ends[:-1], [True]])] if len(ends) else ends
    pair = (a_ids[np.searchsorted(a_ends, ends)].astype(np.int64) << B_BITS) | b_ids[np.searchsorted(b_ends, ends)]
    counts = pa.table({"pair": pa.array(pair)}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
    pairs = counts.column("pair").to_numpy()
    order = np.argsort(pairs)
    last = np.concatenate([[0], a_ends])[a.offsets.to_numpy()]
    return {"n_a": np.diff(a.offsets.to_numpy()), "n_b": np.diff(b.offsets.to_numpy()), "n_groups": n_groups,
            "n_links": np.diff(np.searchsorted(ends, last, side="right")), "groups": groups,
            "pairs": pairs[order], "counts": counts.column("count_all").to_numpy()[order], "links": np.searchsorted(pairs[order], pair).astype(np.int32)}


_TOKENS: dict[tuple[str, str], Tokens] = {}


def _places(pairs: int) -> np.dtype:
    """The narrowest type for a position among so many pairs."""
    return np.min_scalar_type(max(pairs - 1, 0))


def _pack(links: np.ndarray, pairs: int) -> bytes:
    return pa.compress(links.astype(_places(pairs)).tobytes(), CODEC, asbytes=True)


def _unpack(packed: bytes, links: int, pairs: int) -> np.ndarray:
    kind = _places(pairs)
    return np.frombuffer(pa.decompress(packed, links * kind.itemsize, CODEC), kind)


def _of_block(column) -> pa.ListArray:
    """One row that holds the whole column."""
    values = column if isinstance(column, pa.Array) else pa.array(column)
    return _lists(np.array([0, len(values)]), values)


def _sha(text: str | None) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def _blocks(path_a: str, path_b: str):
    def run(batches):
        if (path_a, path_b) not in _TOKENS:
            _TOKENS[path_a, path_b] = Tokens(path_a, path_b)
        tokens, part, number = _TOKENS[path_a, path_b], TaskContext.get().partitionId(), 0
        ids: list = []
        texts: list = []
        chars = 0

        def block() -> pa.RecordBatch:
            a, b = tokens.encode(texts)
            found = align(a, b, tokens.a_size, tokens.b_size, tokens.a_text, tokens.b_text)
            small = {k: np.asarray(found[k]).astype(np.int32) for k in ("n_a", "n_b", "n_groups", "n_links")}
            columns = {"doc_ids": pa.array(ids, pa.int64()), **small, "groups": pa.array([_sha(x.as_py()) for x in found["groups"]], pa.string()),
                       "pairs": found["pairs"], "counts": found["counts"]}
            links = pa.array([_pack(found["links"], len(found["pairs"]))], pa.binary())
            made = [pa.array([(part << 32) | number], pa.int64()), *map(_of_block, columns.values()), links]
            return pa.RecordBatch.from_arrays(made, ["block", *columns, "links"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if ids and chars + len(text or "") > BLOCK_CHARS:
                    yield block()
                    number, ids, texts, chars = number + 1, [], [], 0
                ids.append(doc_id)
                texts.append(text)
                chars += len(text or "")
        if ids:
            yield block()

    return run


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair, total, best`` of the whole corpus: how many links hold the pair, and whether no other pair of its B id has more."""
    total = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("total"))
    b = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    total = written(total.withColumn("b", b))
    most = total.groupBy(F.col("b").alias("most_b")).agg(F.max("total").alias("most"))
    return total.join(most, F.col("b") == F.col("most_b")).select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


_NAMES = [x.split(" ")[0] for x in ALIGNED.split(", ")]


def _finish(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's documents with what its pairs count in the corpus."""
    if _TOKENS:  # the worker that encoded: its vocabularies have done their work
        _TOKENS.clear()
        trim()
    row = {c: left.column(c).combine_chunks().flatten() for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups")}
    place = right.column("place").to_numpy()
    total, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    total[place] = right.column("total").to_numpy()
    best[place] = right.column("best").cast(pa.int64()).to_numpy()
    ends = np.cumsum(row["n_links"].to_numpy().astype(np.int64))
    links = _unpack(left.column("links")[0].as_py(), int(ends[-1]), len(place))
    per_document = lambda of: pa.array(np.diff(np.concatenate([[0], np.cumsum(of[links])])[np.concatenate([[0], ends])]))
    longs = [row[c].cast(pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    return pa.Table.from_arrays([row["doc_ids"], *longs, per_document(best), per_document(total), row["groups"]], _NAMES)


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``ALIGNED`` of every row of ``docs(doc_id, text)`` by the byte-level vocabulary ``path_a`` and the piece vocabulary ``path_b``."""
    python_path(docs.sparkSession)
    blocks = written(docs.selectExpr("cast(doc_id as long) AS doc_id", "cast(text as string) AS text").mapInArrow(tidy(_blocks(path_a, path_b)), BLOCKS),
                     compression="zstd", maxRecordsPerFile=str(FILE_BLOCKS))
    counts = pair_counts(blocks)
    places = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    looked_up = places.join(counts, "pair").select(F.col("block").alias("of_block"), "place", "total", "best")
    return blocks.select("block", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups", "links").groupBy("block").cogroup(looked_up.groupBy("of_block")).applyInArrow(_finish, ALIGNED)
