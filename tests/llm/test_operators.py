"""The operators against brute force, on small frames and whole small tables."""

from __future__ import annotations

import collections
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paritas.llm import (chat, decontamination, html_template, line_quality, neighbours, ngram_join, packing, queries, sharding,
                         token_files, tokens, url_reputation)
from paritas.llm.common import read, scratch
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, "x" * 30000), (7, "a  b\n\nc\td <|endoftext|> é\u00a0ü  "), (None, "one two three four five six")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).withColumns({"score": F.lit(1), "label": F.lit("x"), "n": F.lit(0), "part": F.lit(0)})


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.default_vocabulary())
    t.encode_special_tokens = True
    return t


# ---- sharding -----------------------------------------------------------------------------


def test_table_is_filled_by_turns_and_a_lost_shard_moves_little():
    names = {f"s{k}": 1 for k in range(7)}
    table = sharding.fill_table(names, 1009)
    share = np.bincount(table)
    assert share.max() - share.min() <= 1
    fewer = sharding.fill_table({k: 1 for k in list(names)[:-1]}, 1009)
    stays = table < 6
    assert (table[stays] == fewer[stays]).mean() > 0.75
    heavy = np.bincount(sharding.fill_table({"a": 3, "b": 1}, 1009))
    assert abs(heavy[0] - 3 * heavy[1]) <= 4
    for bad in (1000, 2_000_003):
        with pytest.raises(ValueError):
            sharding.fill_table(names, bad)


def test_table_against_the_turns_written_out():
    size, names = 31, ["a", "b", "c"]
    import hashlib
    want, claimed = {}, {n: iter(()) for n in names}
    for n in names:
        h = hashlib.sha256(n.encode()).digest()
        at, skip = int.from_bytes(h[:8], "big") % size, int.from_bytes(h[8:16], "big") % (size - 1) + 1
        claimed[n] = iter([(at + k * skip) % size for k in range(size)])
    while len(want) < size:
        for k, n in enumerate(names):
            slot = next((s for s in claimed[n] if s not in want), None)
            if slot is not None and len(want) < size:
                want[slot] = k
    assert sharding.fill_table({n: 1 for n in names}, size).tolist() == [want[i] for i in range(size)]


def test_placement(spark, odd, tmp_path):
    got = sharding.place(odd, "doc_id", {"a": 1, "b": 1}, 101).collect()
    assert len(got) == len(ODD) and len({(r.doc_id, r.slot) for r in got}) == len({d for d, _ in ODD})
    spread = sharding.place(spark.range(2000).withColumn("k", F.lit("hot")), "k", {"a": 1, "b": 1}, 101, spread=64, salt="id")
    assert min(r["count"] for r in spread.groupBy("shard").count().collect()) > 500
    assert sharding.place(odd.limit(0), "doc_id", {"a": 1}, 101).count() == 0


# ---- tokens, files, packing ------------------------------------------------------------------


def test_encoder_equals_the_library(library):
    r = random.Random(5)
    alphabet = ["a", "the", " ", "  ", "\n", "\t", "\u00a0", "é", "'s", "12", "!!", "日本", "<|endoftext|>", "\x1c", "x" * 70]
    texts = ["".join(r.choice(alphabet) + r.choice(["", " "]) for _ in range(r.randint(0, 40))) for _ in range(600)] + [t or "" for _, t in ODD]
    e = tokens.Encoder(tokens.default_vocabulary())
    for _ in range(2):
        got = e.encode(texts, 0)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [[*x.ids, 0] for x in library.encode_batch(texts, add_special_tokens=False)]


def test_encoder_keeps_the_pieces_that_are_asked_for(monkeypatch):
    monkeypatch.setattr(tokens, "PIECES", 40)
    e, asked = tokens.Encoder(tokens.default_vocabulary()), []
    pieces = e._pieces
    e._pieces = lambda new: asked.extend(new) or pieces(new)
    for i in range(40):
        e.encode([f"x the of {' '.join(f'w{i}v{j}' for j in range(5))}"], 0)
    assert asked.count("the") == asked.count("of") == 1 and len(asked) == 202


def test_encoder_asks_once_for_a_word_beside_marks_and_line_ends():
    e, asked = tokens.Encoder(tokens.default_vocabulary()), []
    pieces = e._pieces
    e._pieces = lambda new: asked.extend(new) or pieces(new)
    e.encode(["x word, word. word! word\nword; é-word été, été.\nété"], 0)
    assert sorted(asked) == ["word", "é", "été"]


def test_encoder_cuts_only_where_the_library_begins_a_piece(library):
    r = random.Random(8)
    white = [chr(c) for c in range(0x3001) if chr(c).isspace()] + ["\u180e", "\u200b", "\x00", "\x7f"]
    others = ["a", "An", "é", "×", "÷", "ɏ", "ж", "҂", "ª", "º", "²", "½", "ʼ", "·", "\u0301", "—", "字", "か", "한", "😀", "'", "'s", "’", ".", "!?", "7", "_"]
    texts = ["".join(r.choice(white if r.random() < 0.2 else [" ", "\n", "\t"] if r.random() < 0.3 else others) for _ in range(r.randint(0, 12))) for _ in range(20000)]
    got = tokens.Encoder(tokens.default_vocabulary()).encode(texts, 0)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [[*x.ids, 0] for x in library.encode_batch(texts, add_special_tokens=False)]


def test_encoder_takes_slices_and_nulls(library):
    texts = ["skipped, ", "one two.\nThree", None, "", "two."]
    e = tokens.Encoder(tokens.default_vocabulary())
    for _ in range(2):
        got = e.encode_array(pa.array(texts).slice(1), 0)
        assert got.to_pylist() == [[*library.encode(t or "", add_special_tokens=False).ids, 0] for t in texts[1:]]
    assert e.encode_array(pa.array([], pa.string()), 0).to_pylist() == []


def test_batches_are_put_together_in_order_up_to_a_size():
    batches = [pa.RecordBatch.from_pydict({"k": [i], "text": ["x" * 60]}) for i in range(10)]
    got = [b.column("k").to_pylist() for b in tokens.gathered(iter(batches), size=200)]
    assert sum(got, []) == list(range(10)) and 1 < len(got) < 10


def _ids(library, rows):
    return [(d, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in rows]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, odd, library, encoding):
    path = scratch(spark)
    token_files.write_tokens(odd, path, tokens.default_vocabulary(), encoding=encoding)
    got = [tuple(r) for r in token_files.checksums(spark, path).orderBy("start").collect()]
    want = {(d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in _ids(library, ODD)}
    assert {(d, n, c) for d, _, n, c in got} == want and len(got) == len(ODD)
    assert [s for _, s, _, _ in got] == [0, *itertools.accumulate(n for _, _, n, _ in got)][:-1]
    assert [d for d, *_ in got] == sorted((d for d, _ in ODD), key=lambda d: (d is not None, d))
    some = token_files.read_tokens(spark, path, 4, 5)
    assert sorted(r.doc_id for r in some.collect()) == [4, 5, 5] and "PushedFilters: [IsNotNull(doc_id)" in some._jdf.queryExecution().toString()
    assert "ids" not in token_files.read_metadata(spark, path)._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split(">")[0]
    assert token_files.read_metadata(spark, path).count() == len(ODD)
    with pytest.raises(ValueError):
        token_files.write_tokens(odd, path, "", encoding="other")


@pytest.mark.parametrize("seed", range(25))
def test_packing_plan_is_gapless_and_near_the_optimum(seed):
    r = random.Random(seed)
    cap = r.choice([10, 12, 30])
    lengths = [r.randint(1, cap) for _ in range(r.randint(1, 12))]
    bins = collections.defaultdict(list)
    for x, lo, hi, first, at, each in packing.plan(collections.Counter(lengths), cap):
        for k in range(hi - lo):
            bins[first + k // each].append((at + k % each * x, x))
    assert sorted(x for b in bins.values() for _, x in b) == sorted(lengths)
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == [0, *itertools.accumulate(x for _, x in sorted(b))][:-1] and sum(x for _, x in b) <= cap

    def best(left, rooms, limit):
        if len(rooms) >= limit:
            return limit
        if not left:
            return len(rooms)
        x, rest = left[0], left[1:]
        for i in {room: i for i, room in enumerate(rooms) if room >= x}.values():
            limit = min(limit, best(rest, rooms[:i] + [rooms[i] - x] + rooms[i + 1:], limit))
        return min(limit, best(rest, rooms + [cap - x], limit))

    optimum = best(sorted(lengths, reverse=True), [], len(lengths))
    assert optimum <= len(bins) <= optimum + 1
    fixed = packing._reduce([collections.Counter(lengths)[i] for i in range(cap + 1)], cap)
    left = collections.Counter(lengths)
    for runs, n in fixed:
        for x, c in runs:
            left[x] -= n * c
    rest = sorted(left.elements(), reverse=True)
    assert sum(n for _, n in fixed) + best(rest, [], len(rest)) == optimum  # what is fixed costs nothing


def test_pieces_and_pack(spark, odd, library):
    cut = packing.pieces(odd, tokens.default_vocabulary(), 64)
    rows = packing.pack(cut.withColumn("extra", F.lit("x")), 64).collect()
    want = collections.Counter()
    for d, ids in _ids(library, ODD):
        n = len(ids) - (len(ids) - 1) // 64 * 64
        for k, (i, j) in enumerate(itertools.pairwise([0, *range(n, len(ids) + 1, 64)])):
            want[d, k, i, j - i, np.array(ids[i:j], "<u4").tobytes()] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for b in by.values():
        assert [o for o, _ in sorted(b)] == [0, *itertools.accumulate(x for _, x in sorted(b))][:-1]
    assert packing.pack(cut.limit(0), 64).count() == 0


# ---- chat -------------------------------------------------------------------------------------


def test_escape_is_reversible_and_hides_control_strings():
    r = random.Random(2)
    parts = [*chat.CONTROL, "\\", "<", "\\\\", "s>", "[", "ok", "|", ">"]
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 9)))
        assert chat.unescape(chat.escape(t)) == t and not any(c in chat.escape(t) for c in chat.CONTROL)
        assert chat.parse(chat.render("user", t)[0] + chat.render(t, "x")[0]) == [("user", t), (t, "x")]


def _folded(events):
    """Events in order of sequence applied one by one."""
    turns: dict[int, list] = {}
    for _, kind, turn, role, text in sorted(events, key=lambda e: e[0]):
        if kind in ("edit", "regenerate"):
            turns = {t: v for t, v in turns.items() if t <= turn}
        if turn not in turns:
            turns[turn] = [role or "unknown", ""]
        if kind != "delta":
            turns[turn] = [role or turns[turn][0], ""]
        if kind != "regenerate":
            turns[turn][1] += text or ""
    return [tuple(turns[t]) for t in sorted(turns)]


def test_fold_against_a_plain_replay(spark):
    r = random.Random(9)
    rows, want = [], {}
    for conv in [None, *range(40)]:
        seqs = itertools.count()
        events = [(next(seqs), r.choice(["message", "delta", "delta", "edit", "regenerate"]), r.randint(0, 4), r.choice(["user", "assistant", None]),
                   r.choice([None, "", "hi ", "</s>", "\\"])) for _ in range(r.randint(1, 25))]
        rows += [(conv, s, k, t, ro, x) for s, k, t, ro, x in events]
        want[conv] = _folded(events)
    r.shuffle(rows)
    log = spark.createDataFrame(rows, chat.LOG).withColumn("position", F.lit("clash"))
    got = collections.defaultdict(list)
    for s in chat.format_log(log).collect():
        got[s.conv_id].append((s.position, s.segment))
    assert {c: [m for _, seg in sorted(v) for m in chat.parse(seg)] for c, v in got.items()} == want
    assert chat.digests(chat.format_log(log.limit(0))).count() == 0


# ---- decontamination -----------------------------------------------------------------------------


def test_common_subsequence():
    r = random.Random(1)

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    for _ in range(500):
        a, b = ([r.randint(0, 5) for _ in range(r.randint(1, 20))] for _ in range(2))
        assert decontamination.common_subsequence(a, b) == plain(a, b)


def test_leaks_copies_and_paraphrases(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("bcdfghklmnprstv") + r.choice("aeiou") for _ in range(r.randint(1, 3)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(r.randint(10, 60)) + ". " + text(6) + ".") for i in range(30)] + [(90, None), (91, ""), (92, items_short := "zubu kora lemi")]
    docs, leaks = [(k, text(r.randint(0, 300))) for k in range(150)], set()
    for k in range(0, 60, 2):
        i = k // 2
        words = items[i][1].split()
        if k % 4:
            for j in r.sample(range(len(words) - 7), max(1, len(words) // 6)):
                words[j] = word()
        docs.append((1000 + k, text(r.randint(0, 90)) + " " + " ".join(words).upper() + " " + text(r.randint(0, 200))))
        leaks.add((1000 + k, i))
    docs += [(2000, None), (2001, ""), (2002, f"a {items_short} b"), (2003, "zubu a kora b lemi"), (1000, dict(docs)[1000]), (None, items[3][1])]
    leaks |= {(2002, 92), (None, 3)}
    frame = spark.createDataFrame(docs, DOCS).withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.search(frame, bench)
    assert {(x.doc_id, x.item_id) for x in got.collect()} == leaks
    kept = decontamination.clean(frame, bench)
    assert kept.columns == frame.columns
    bad = {d for d, _ in leaks}
    assert collections.Counter(x.doc_id for x in kept.collect()) == collections.Counter(d for d, _ in docs if d not in bad)
    assert decontamination.search(frame, bench.limit(0)).count() == 0 and decontamination.clean(frame.limit(0), bench).count() == 0


def _checked(docs, items, options=decontamination.OPTIONS):
    """(doc_id, item_id) that the check accepts in any window, each pair checked."""
    out, base = set(), decontamination.BASE
    for d, text in docs:
        words = decontamination.words_of(text)
        for i, item in items:
            want, answer = decontamination.words_of(item), decontamination.words_of(decontamination.answer_of(item))
            size = max(2, -(-len(want) // base))
            apart, margin = max(1, size // 4) * base, size * base // 2
            for at in range(0, max(1, len(words) - size * base + apart), apart):
                span = words[max(0, at - margin): at + size * base + margin]
                same = decontamination.common_subsequence(want, span) / len(want)
                if same >= options["verbatim"] or same >= options["paraphrase"] and decontamination.common_subsequence(answer, span) >= options["answer"] * len(answer):
                    out.add((d, i))
                    break
    return out


def test_no_paraphrase_that_the_check_accepts_is_left_out(spark):
    r = random.Random(8)
    items = [(x.item_id, x.text) for x in read(spark, SF_SMALL, "benchmark").orderBy("item_id").limit(25).collect()]
    texts = [decontamination.words_of(x.text) for x in read(spark, SF_SMALL, "documents").orderBy("doc_id").limit(120).collect()]
    seen = collections.Counter(w for t in texts for w in set(t))
    pool, docs = [w for t in texts for w in t], []
    for k in range(150):
        item = r.choice(items)[1]
        words, kept = decontamination.words_of(item), len(decontamination.words_of(decontamination.answer_of(item)))
        rare = sorted(range(len(words) - kept), key=lambda j: seen[words[j]])  # the rarest are exchanged, the last sentence stays
        for j in rare[: round(r.uniform(0.2, 0.45) * len(words))]:
            words[j] = r.choice(pool)
        near = r.choice(texts)
        docs.append((k, " ".join(near[:r.randint(0, 60)] + words + near[60: 60 + r.randint(0, 60)])))
    want = _checked(docs, items)
    assert len(want) > 100
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    assert {(x.doc_id, x.item_id) for x in decontamination.search(*frames, exact=True).collect()} == want
    found = {(x.doc_id, x.item_id) for x in decontamination.search(*frames).collect()}
    assert found <= want and len(found) >= 0.95 * len(want)


def test_recall_of_latent_search_over_blocks(spark, monkeypatch):
    """All items of two blocks against all pairs of the check, and the same result whatever the size of a block."""
    items = [(x.item_id, x.text) for x in read(spark, SF_SMALL, "benchmark").orderBy("item_id").collect()]
    r = random.Random(21)
    docs = []
    for k, (_, item) in enumerate(items * 3):
        words = decontamination.words_of(item)
        keep = len(words) - len(decontamination.words_of(decontamination.answer_of(item)))
        for j in r.sample(range(keep), keep // 5):
            words[j] = "unheard"
        docs.append((k, " ".join(words)))
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    want = _checked(docs, items)
    for block in (256, 16):
        monkeypatch.setattr(decontamination, "BLOCK", block)
        found = {(x.doc_id, x.item_id) for x in decontamination.search(*frames).collect()}
        assert found <= want and len(found) >= 0.95 * len(want)
        kept = {x.doc_id for x in decontamination.clean(*frames).collect()}
        assert kept == {d for d, _ in docs} - {d for d, _ in found}


def test_singular_vectors_equal_a_plain_svd(spark):
    texts = [f"{a} {b} {a} c{k % 5}" for k, (a, b) in enumerate((f"a{i}", f"b{j}") for i in range(6) for j in range(5))]
    vocabulary = sorted({w for t in texts for w in t.split()})
    number = {w: i + 1 for i, w in enumerate(vocabulary)}
    idf = np.r_[0.0, np.linspace(0.5, 3, len(vocabulary))]
    dense = np.zeros((len(texts), len(idf)))
    for row, t in zip(dense, texts):
        for w in t.split():
            row[number[w]] += idf[number[w]]
    got = decontamination.singular_vectors(spark.createDataFrame([(t,) for t in texts], "text string"), number, idf, 6)
    _, _, right = np.linalg.svd(dense)
    assert np.allclose(np.abs(got.T @ right[:6].T), np.eye(6), atol=1e-3)
    index = decontamination.Index([(1, texts[0])], number, idf, right.T, 0.75, 0.55, 0.8, 0.2, False)
    plain = lambda a, b: a @ b / np.sqrt((a @ a) * (b @ b))
    assert abs(index._score(decontamination.Terms(number).encode(texts[7]), 0) - plain(dense[7], dense[0])) < 1e-5


def test_short_items_are_found_between_heavy_words(spark):
    r = random.Random(12)
    texts = [w for x in read(spark, SF_SMALL, "documents").orderBy("doc_id").limit(120).collect() if len(w := decontamination.words_of(x.text)) > 90]
    items, docs = [], []
    for k in range(60):
        n, t = 3 + k % 5, r.choice(texts)
        at = r.randint(0, len(t) - n)
        items.append((k, " ".join(t[at: at + n])))
        near = r.choice(texts)
        docs.append((k, " ".join(near[:r.randint(0, 60)] + t[at: at + n] + near[60: 60 + r.randint(0, 30)])))
    items += [(100, " ".join(w for t in texts for w in t))]  # every word of the texts is a term, and weighs
    want = {(d, i) for d, t in docs for i, x in items if f" {x} " in f" {t} "}
    assert len(want) >= 60
    got = decontamination.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id) for x in got.collect()} == want


# ---- neighbours ------------------------------------------------------------------------------------


def _nearest(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    norm = np.sqrt((x * x).sum(1))
    out = {}
    for i in range(len(ids)):
        score = (x * x[i]).sum(1) / (norm * norm[i])
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [int(ids[j]) for j in order]
    return out


def test_neighbours_recall_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 64)
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    r = np.random.default_rng(4)
    base = r.standard_normal((900, 24)).astype(np.float32)
    base[300:600] = base[7]  # one vector has a third of all rows
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    odd = [(5000, None), (5050, [0.0] * 24), (5100, [float("nan")] * 24), (5150, [None] + [1.0] * 23), (5200, [1.0] * 3), (5250, []), (None, [1.0] * 24), rows[3]]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("score", F.lit(0))
    got = collections.defaultdict(list)
    for x in neighbours.search(frame, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[x.query_id].append(x.vec_id)
    want = _nearest(rows, 5)
    assert set(got) == set(range(0, 900, 50))
    hits = sum(len(set(got[q]) & set(want[q])) for q in got)
    assert hits >= 0.95 * 5 * len(got)
    assert got[350] == [7, 300, 301, 302, 303] and got[300] == [7, 301, 302, 303, 304]
    few = neighbours.search(frame.filter("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).collect()
    assert sorted(x.vec_id for x in few) == [1, 2]
    assert neighbours.search(frame.limit(0), F.col("vec_id") == 0).count() == 0


def test_chi_square_quantile():
    assert abs(neighbours.chi_square_quantile(0.95, 2) - 5.991) < 1e-2 and abs(neighbours.chi_square_quantile(0.99, 8) - 20.09) < 1e-2


# ---- HTML ---------------------------------------------------------------------------------------------


PAGE = """<!doctype html><html><head><title>T</title><script>if (a<b) x("</p>")</script></head><body class="x"><header>Site</header>
<nav><ul><li><a href=/a>Home</a><li><a href=/b>More</a></ul></nav><div class="cookie-notice">Cookies!</div>
<main><h1>Head &amp; line</h1><p>One <b>bo</b>ld<br>two<p>three <form>name <input></form><aside>side</aside> &copy four</main>
<div id="comments-7"><p>me too</div><footer>end</footer>"""


def test_page_without_article_and_with_main(spark):
    plain = "<html><body><div class=menu><a href=x>m</a></div><div><p>Only text %d</p><p>and more</p></div><div>Copyright us</div></body></html>"
    rows = [(k, f"http://h{k % 2}.example/{k}", PAGE) for k in range(6)] + [(100 + k, "http://plain.example/x", plain % k) for k in range(12)]
    rows += [(200, None, None), (201, "nothing", ""), (202, "http://h0.example/", "<p>broken <b>page"), (202, "http://h0.example/", "<p>broken <b>page")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("clash"), "template": F.lit(1), "text": F.lit(2)})
    got = {x.page_id: (x.text, x.n_chars) for x in html_template.extract(frame).collect()}
    assert got[0][0] == "Head & line One bold two three \u00a9 four"
    assert got[103][0] == "Only text 3 and more Copyright us" or got[103][0] == "Only text 3"
    assert got[200] == ("", 0) and got[201] == ("", 0) and got[202][0] == "broken page"
    assert html_template.extract(frame.limit(0)).count() == 0


def test_copies_of_a_page_without_article_keep_their_text(spark):
    page = "<html><body><div>Copyright us</div><div><p>%s</p><p>and more</p></div></body></html>"
    rows = [(k, f"http://three.example/{k}", page % "one text") for k in range(3)] + [(k, f"http://many.example/{k}", page % "one text") for k in range(10, 3010)]
    rows += [(k, f"http://most.example/{k}", page % "one text") for k in range(4000, 4040)]
    rows += [(k, f"http://most.example/{k}", "<html><body><div>Copyright us</div><div><p>other %d</p></div></body></html>" % k) for k in (4100, 4101)]
    got = {x.page_id: x.text for x in html_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows) and {got[k] for k in [*range(3), *range(10, 3010)]} == {"Copyright us one text and more"}
    assert {got[k] for k in range(4000, 4040)} == {"one text and more"} and got[4100] == "other 4100" and got[4101] == "other 4101"


# ---- n-gram join ------------------------------------------------------------------------------------------


def _components(rows, k, percent):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i: i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    root = {d: d for d in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = a, b
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)

    def top(d):
        return d if root[d] == d else top(root[d])
    return {d: (len(sets[d]), top(d)) for d in sets}


@pytest.mark.parametrize("k,percent,block", [(3, 90, 2_000_000), (5, 85, 600), (5, 80, 2_000_000)])
def test_join_against_all_pairs(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)
    r = random.Random(percent)
    words = ["w%d" % i for i in range(400)]
    line = [r.choice(words) for _ in range(12)]
    docs = [[r.choice(words) for _ in range(r.choice([0, 1, 2, 9, 15, 40, 120, 300]))] for _ in range(60)]
    for _ in range(180):  # copies with a few edits, many of them of two documents
        d = list(docs[r.choice([50, 51, r.randint(0, len(docs) - 1)])])
        for _ in range(r.choice([0, 1, 1, 2, 4])):
            if d:
                d[r.randrange(len(d))] = r.choice(words)
        docs.append(d)
    docs += [line + d for d in docs[:60]]
    rows = [(i, " ".join(d).replace("w1", "W1")) for i, d in enumerate(docs)] + [(9000, None), (9001, ""), (9002, "ab"), (9003, "AB")]
    frame = spark.createDataFrame(rows + [rows[70]], DOCS).withColumns({"n": F.lit(1), "node": F.lit(2), "key": F.lit(3)})
    _, got = ngram_join.join(frame, words=k, percent=percent)
    got = got.collect()
    assert len(got) == len(rows) + 1
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == _components(rows, k, percent)


def test_search_scores_ties_and_copies_like_brute_force():
    """Many equal distances around the last place of a block's answer: the least ids of the best scores."""
    r = np.random.default_rng(4)
    x = np.repeat(r.integers(-1, 2, (40, 4)) + np.array([0.5, 0, 0, 0]), 3, axis=0) * r.choice([1.0, 2.0, 4.0], (120, 1))
    n = len(x)
    cands = pa.table({"vec": x.tolist(), "point": x.tolist(), "ids": [[i] for i in range(n)], "k1": range(n), "k2": range(n)})
    asks = pa.table({"q1": range(9), "q2": range(9), "copies": [1] * 9, "vec": x[:9].tolist(), "point": x[:9].tolist(), "bound": [1e9] * 9})
    got = neighbours._search(5, 4, 100.0)(cands, asks).to_pylist()
    for i in range(9):
        score = (x @ x[i]) / np.sqrt((x * x).sum(1) * (x[i] * x[i]).sum())
        best = np.sort(score)[::-1][:6]
        np.testing.assert_allclose([g["score"] for g in got if g["q1"] == i], best, atol=1e-12)


def test_join_of_odd_rows(spark, odd):
    _, got = ngram_join.join(odd, words=3, percent=90)
    got = {(x.doc_id, x.n_shingles, x.component_id) for x in got.collect()}
    assert got == {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 4, 7), (None, 4, None)}
    assert ngram_join.join(odd.limit(0))[1].count() == 0


def test_sketch_bounds_the_difference():
    bands, r = ngram_join.Bands(80), np.random.default_rng(0)
    for _ in range(50):
        a = np.unique(r.integers(0, 1 << 63, 200).astype(np.uint64))
        b = np.unique(np.r_[a[r.random(len(a)) > 0.1], r.integers(0, 1 << 63, 12).astype(np.uint64)])
        x, y = (bands.sketch(s, bands.of(max(len(a), len(b)))) for s in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))
        b = a[: r.integers(1, len(a))]  # sketches of unlike widths
        x, y = (np.frombuffer(ngram_join.small_sketch(s), np.uint64)[None] for s in (np.r_[a, a + np.uint64(1 << 20)], b))
        apart = np.bitwise_count(ngram_join.fold(x, y.shape[1]) ^ y).sum()
        assert x.shape[1] > y.shape[1] and apart <= 2 * len(a) - len(b)


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_linked_sets_share_a_key(percent):
    """Sets as far apart as a link allows, of all sizes and on both sides of band edges."""
    bands, r, linked = ngram_join.Bands(percent), np.random.default_rng(percent), 0
    for n in [1, 4, 5, 8, 9, 15, 16, 17, 31, 60, 64, 100, 127, 128, 250, 256, 300, 1000]:
        for _ in range(40):
            a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
            gone = r.integers(0, n * (100 - percent) // 100 + 1)
            room = max(0, (n - gone) * 100 // percent - n)  # at most these may be added
            b = np.unique(np.r_[r.permutation(a)[gone:], r.integers(0, 1 << 63, r.integers(0, room + 1)).astype(np.uint64)])
            if bands.linked(a, b) and len(np.setxor1d(a, b)):
                linked += 1
                assert np.intersect1d(bands.keys(a), bands.keys(b)).size
    assert linked > 300


def test_unlike_sets_share_no_key():
    """By the bits of a chunk alone thousands of these pairs would meet, more with the square of the sets."""
    bands, r = ngram_join.Bands(80), np.random.default_rng(3)
    keys = np.concatenate([np.unique(bands.keys(np.unique(r.integers(0, 1 << 64, n, np.uint64)))) for n in r.integers(60, 400, 1000)])
    assert len(keys) > 20_000 and len(np.unique(keys)) == len(keys)


def test_one_row_of_each_group_stays_when_a_document_has_two_texts(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    rows = [(3, x), (5, x), (5, y), (9, y), (9, y), (7, z), (7, z + " end"), (11, ""), (11, None), (None, x), (None, x)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("other", F.lit("o"))
    _, found = ngram_join.join(frame, words=corpus_pipeline.SHINGLE_WORDS, percent=corpus_pipeline.SIMILARITY)
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(3, 3), (5, 3), (9, 3), (7, 7), (11, 11), (None, None)}
    kept = corpus_pipeline.near_duplicates(spark, frame, SF_SMALL)
    got = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    assert kept.columns == frame.columns and sum(got[7, t] for t in (z, z + " end")) == 1
    assert {k: n for k, n in got.items() if k[0] != 7} == {(3, x): 1, (5, y): 1, (11, ""): 1, (11, None): 1, (None, x): 2}


# ---- line quality ---------------------------------------------------------------------------------------------


def test_forward_backward_against_all_paths():
    r = np.random.default_rng(1)
    sizes = [1, 3, 6, 2]
    emit, pair = r.standard_normal(sum(sizes)), r.standard_normal((2, 2))
    starts = np.cumsum([0, *sizes])[:-1]
    good, both, log_z = line_quality.forward_backward(emit, pair, starts)
    for s, n, z in zip(starts, sizes, log_z):
        total, marks, twos = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for path in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(emit[s + i] for i in range(n) if path[i]) + sum(pair[path[i], path[i + 1]] for i in range(n - 1)))
            total += w
            marks += w * np.array(path)
            for i in range(n - 1):
                twos[i, path[i], path[i + 1]] += w
        assert np.allclose(good[s: s + n], marks / total) and np.isclose(z, np.log(total)) and np.allclose(both[s: s + n], twos / total)


def test_quality_on_held_out_labels(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    got = queries.op8_line_quality(spark, sf).filter("held_out").join(read(spark, sf, "labels"), "doc_id").select("predicted", "quality").collect()
    assert len(got) > 50 and np.mean([x.predicted == x.quality for x in got]) > 0.95


def test_quality_of_odd_rows(spark, odd):
    texts = spark.createDataFrame([(k, "Some plain words stand here in a line.\nAnd more of them." if k % 2 else "BAD!! LINE!! HERE!!\nX!! Y!!") for k in range(40)], DOCS)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(1, None), (None, 1)], "doc_id long, label int")
    field = line_quality.train(texts, labels)
    got = line_quality.score(odd, field, ["doc_id"]).collect()
    assert len(got) == len(ODD) and all(0 <= x.score <= 1 for x in got)
    one = {x.score for x in line_quality.score(odd, line_quality.train(texts, labels.filter("label = 1")), ["doc_id"]).collect()}
    none = {x.score for x in line_quality.score(odd, line_quality.train(texts, labels.limit(0)), ["doc_id"]).collect()}
    assert min(one) > 0.999 and none == {0.5}
    empty = texts.limit(0)
    assert line_quality.score(empty, line_quality.train(empty, labels), ["doc_id"]).collect() == []
    with pytest.raises(ValueError):
        line_quality.score(odd, field, odd.columns)


# ---- url reputation ---------------------------------------------------------------------------------------------


def test_urls_rules_and_shrinkage(spark):
    urls = [None, "", "no host", "http://WWW.Example.com/en/x?q#f", "https://a.example.com/en/", "x://example.com", "http://b.net/es/?a", "http://www.example.com/fr#z",
            "http://bad.co.uk/p", "http://new.bad.co.uk/p", "http://ok.org/a://b"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({"host": F.lit("clash"), "a": F.lit(1)})
    outcomes = spark.createDataFrame([("bad.co.uk", 1)] * 60 + [("www.bad.co.uk", 1)] * 60 + [("ok.org", 0)] * 200 + [("ok.org", None), (None, 1)], "host string, bad int")
    got = {x.page_id: x for x in url_reputation.judge(pages, "page_id", outcomes, queries.RULES).collect()}
    assert [(got[k].host, got[k].path) for k in range(11)] == [
        ("", ""), ("", ""), ("", ""), ("www.example.com", "/en/x"), ("a.example.com", "/en/"), ("example.com", ""), ("b.net", "/es/"), ("www.example.com", "/fr"),
        ("bad.co.uk", "/p"), ("new.bad.co.uk", "/p"), ("ok.org", "/a://b")]
    assert [got[k].rule for k in range(11)] == [None, None, None, "www.example.com/en/", "example.com/en/", None, "net/es/", "com/", None, None, None]
    assert [got[k].verdict for k in (3, 4, 6, 7, 8, 9, 10)] == ["allow", "block", "block", "allow", "block", "block", "allow"]
    assert got[10].bad_rate < 0.05 < 0.8 < got[8].bad_rate
    none = url_reputation.judge(pages, "page_id", outcomes.limit(0), queries.RULES).collect()
    assert len(none) == 11 and url_reputation.judge(pages.limit(0), "page_id", outcomes, queries.RULES).count() == 0


# ---- queries and pipeline -------------------------------------------------------------------------------------------


def test_oracles(spark):
    import duckdb

    from paritas.llm.oracle import ORACLES
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    for name, sql in ORACLES.items():
        df = queries.QUERIES[name](spark, SF_SMALL)
        want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall()
        assert collections.Counter(map(tuple, df.collect())) == collections.Counter(want), name


def test_pipeline_against_brute_force(spark, library):
    """Each stage's decisions, by its plain definition, on what the stage before kept."""
    sf = SF_SMALL.replace("0.001", "0.01")
    docs = read(spark, sf, "documents")
    text = {x.doc_id: x.text for x in docs.collect()}
    kept = corpus_pipeline.quality(spark, docs, sf)
    label = {x.doc_id: x.quality for x in read(spark, sf, "labels").collect()}
    ids = {x.doc_id for x in kept.collect()}
    assert kept.columns == docs.columns and np.mean([(d in ids) == (q == 1) for d, q in label.items()]) > 0.95
    groups = _components([(d, text[d]) for d in ids], corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILARITY)
    ids = {d for d in ids if groups[d][1] == d}
    items = [decontamination.words_of(x.text) for x in read(spark, sf, "benchmark").collect()]
    ids = {d for d in ids if not any(f" {' '.join(i)} " in f" {' '.join(decontamination.words_of(text[d]))} " for i in items)}
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {x.doc_id for x in rows} == ids
    assert sum(x.length for x in rows) == sum(len(library.encode(text[d], add_special_tokens=False).ids) + 1 for d in ids)
