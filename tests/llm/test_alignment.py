"""Alignment against pairwise comparison of byte ranges."""

import hashlib
import random

import pytest

import public_tokenizers
from paritas.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def pieces(libraries, text):
    """(id, bytes) of each token of both sides from the libraries' own calls on the whole text."""
    a, b = libraries
    byte_of = alignment._byte_of()
    left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    return left, right


def ranges(tokens):
    at, out = 0, []
    for i, x in tokens:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute(libraries, rows):
    found, count = [], {}
    for doc, text in rows:
        left, right = pieces(libraries, text) if text else ([], [])
        whole = f" {text}".encode()
        if not text or b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
            found.append((doc, 0, 0, 0, [], ""))
            continue
        ra, rb = ranges(left), ranges(right)
        links = [(x[0], y[0]) for x in ra for y in rb if x[1] < y[2] and y[1] < x[2]]
        for p in links:
            count[p] = count.get(p, 0) + 1
        cuts = sorted({e for _, _, e in ra} & {e for _, _, e in rb})
        start, groups = 0, []
        for e in cuts:
            groups.append(",".join(str(i) for i, s, t in ra if start <= s and t <= e) + "|" + ",".join(str(i) for i, s, t in rb if start <= s and t <= e))
            start = e
        found.append((doc, len(ra), len(rb), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(((d, a, b, g, len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), sha) for d, a, b, g, links, sha in found), key=repr)


def texts(rng, n):
    words = ["the", "Überraschung", "naïve", "été", "x", "tokenization", "日本語", "🙂👍", "</s>", "<|endoftext|>", "<s>", "<0x41>", "▁", "a▁b", "ﬁ", " ", "\x00", "\x1c", "\t", "\n",
             "don't", "3.14159", "", "", "  ", "\r\n", "ÿ", "é", "​", "﻿", "end."]
    return ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "", "\n", "  "]) for _ in range(rng.randrange(25))) for _ in range(n)]


def test_words_are_encoded_as_in_the_whole_text(libraries):
    tokens = alignment.Tokens(A, B)
    samples = [t for t in texts(random.Random(1), 400) if t]
    a, b = tokens.encode(samples)
    for text, x, y in zip(samples, a.to_pylist(), b.to_pylist()):
        left, right = pieces(libraries, text)
        spelled = b"".join(v for _, v in left) == b"".join(v for _, v in right) == f" {text}".encode()
        assert (x, y) == (([i for i, _ in left], [i for i, _ in right]) if spelled else ([], [])), repr(text)
        assert spelled or alignment.SPACE in text


def run(df):
    return sorted((tuple(r) for r in alignment.align_documents(df, A, B).collect()), key=repr)


def test_whole_table_equals_pairwise_overlaps(spark, libraries):
    rng = random.Random(6)
    rows = [(k, t) for k, t in enumerate(texts(rng, 120))] + [(None, "no id"), (5, "again"), (5, "again"), (6, None), (7, ""), (8, " "), (9, "word " * 300)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id int, text string, n_a int, block int")
    assert run(df.repartition(3)) == brute(libraries, rows)


def test_long_text_is_one_block_and_empty_table(spark):
    long = "ein langer Satz, the same again. " * 90_000  # longer than a block
    got = run(spark.createDataFrame([(1, long), (2, "ein Satz"), (3, None)], "doc_id long, text string").coalesce(1))
    assert got[0][1] > 500_000 and got[2][1:] == (0, 0, 0, 0, 0, 0, "") and len(got) == 3
    assert got[0][4] == got[0][1] + got[0][2] - got[0][3]
    assert run(spark.createDataFrame([], "doc_id long, text string")) == []
    assert run(spark.createDataFrame([(1, None)], "doc_id long, text string")) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_partial_counts_sum_to_the_links():
    tokens = alignment.Tokens(A, B)
    found = alignment.align(*tokens.encode(texts(random.Random(3), 40)), tokens.a_size, tokens.b_size, tokens.a_text, tokens.b_text)
    assert sum(found["counts"]) == sum(found["n_links"]) == len(found["links"]) == sum(found["n_a"]) + sum(found["n_b"]) - sum(found["n_groups"])


def test_positions_are_packed_and_read_back():
    rng = alignment.np.random.default_rng(2)
    for pairs in (0, 1, 2, 256, 257, 65_536, 65_537):
        links = rng.integers(0, max(pairs, 1), 1000 if pairs else 0).astype(alignment.np.int32)
        assert (alignment._unpack(alignment._pack(links, pairs), len(links), pairs) == links).all()


def test_rows_of_blocks_stay_small(spark, monkeypatch):
    """A block's links, most of its row, take less than two bytes each, and a file holds few blocks."""
    made = []
    monkeypatch.setattr(alignment, "written", lambda df, real=alignment.written, **options: made.append(real(df, **options)) or made[-1])
    monkeypatch.setattr(alignment, "FILE_BLOCKS", 2, raising=False)
    rng = random.Random(4)
    words = ["tokenization", "the", "Überraschung", "3.14159", "don't", "end.", "naïve", "overlapping"]
    docs = [(k, " ".join(rng.choice(words) for _ in range(45_000))) for k in range(5)]
    rows = run(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    blocks = made[0].selectExpr("octet_length(links) AS bytes" if dict(made[0].dtypes)["links"] == "binary" else "4 * size(links) AS bytes",
                                "aggregate(n_links, 0, (a, x) -> a + x) AS n", "input_file_name() AS file").collect()
    assert len(rows) == 5 and sum(b["n"] for b in blocks) == sum(r[4] for r in rows)
    assert len(blocks) == 5 and all(b["bytes"] < 2 * b["n"] for b in blocks)
    assert max(sum(b["file"] == c["file"] for b in blocks) for c in blocks) <= 2


def test_finishing_worker_lets_its_vocabularies_go(monkeypatch):
    tokens = alignment.Tokens(A, B)
    monkeypatch.setattr(alignment, "_TOKENS", {(A, B): tokens})
    monkeypatch.setattr(alignment, "TaskContext", type("Task", (), {"get": classmethod(lambda cls: cls), "partitionId": staticmethod(lambda: 0)}))
    pa = alignment.pa
    made = pa.Table.from_batches(alignment._blocks(A, B)([pa.record_batch({"doc_id": pa.array([7]), "text": pa.array(["the end. the end."])})]))
    places = pa.array(range(len(made.column("pairs")[0])), pa.int32())
    counts = pa.table({"of_block": pa.array([0] * len(places), pa.int64()), "place": places, "total": pa.array([1] * len(places), pa.int64()), "best": pa.array([True] * len(places))})
    found = alignment._finish(made, counts).to_pylist()[0]
    assert found["doc_id"] == 7 and found["n_links"] == found["n_best"] == found["count_sum"] > 0
    assert alignment._TOKENS == {}
