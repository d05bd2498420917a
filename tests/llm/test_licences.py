"""Licence scans against naive search and an evaluator of expression trees."""

import random
import re

import pytest

from paritas.llm import licences


@pytest.fixture(scope="module")
def scanner():
    return licences.Scanner()


def naive(text):
    """Words, places and labels of the phrases, phrase by phrase and word by word."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    place = lambda p: [i for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    base = [(i, v) for p, v in licences.BASE.items() for i in place(p)]
    more = [(i, v) for p, v in licences.PHRASES.items() for i in place(p)]
    at = [i for i, _ in base]
    return (len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({v for _, v in base})),
            ",".join(sorted({v for _, v in base + more})), 1 - 0.5 ** len(base + more))


def test_phrases_equal_naive_search(scanner):
    rng = random.Random(4)
    parts = [w for p in (*licences.BASE, *licences.PHRASES) for w in p.split()] + ["CC BY", "cc\x00by", "Apache\nLicense", "été", "x y", " ", "license", "4.0", "mit", "ﬁ"]
    for _ in range(300):
        text = "".join(rng.choice(parts) + rng.choice([" ", " ", "-", ", ", "\n", "", "\x7f"]) for _ in range(rng.randrange(40)))
        assert scanner.scan(text) == naive(text), text


def tree(rng, depth):
    """A random expression: (text, what it asks, families, how it binds)."""
    if depth == 0 or rng.random() < 0.25:
        name = rng.choice(["MIT", "Apache-2.0", "GPL-2.0-only", "LGPL-2.1+", "MPL-2.0", "BSD-3-Clause", "CC-BY-NC-4.0", "LicenseRef-own", "AGPL-3.0-or-later"])
        fam = max((f for f in licences.FAMILIES if re.match(re.escape(f) + r"([-+.]|$)", name.lower())), key=len, default="other")
        asks = licences.FAMILIES.get(fam, 3)
        if rng.random() < 0.2:
            return name + rng.choice([" with ", " WITH "]) + "Classpath-exception-2.0", asks if asks == 3 else min(asks, 1), {fam}, 3
        return name, asks, {fam}, 3
    sides, op = [tree(rng, depth - 1), tree(rng, depth - 1)], rng.choice(["or", "and"])
    binds = {"or": 1, "and": 2}[op]
    texts = [t if b >= binds and rng.random() < 0.8 else f"({t})" for t, _, _, b in sides]
    return f" {rng.choice([op, op.upper()])} ".join(texts), {"or": min, "and": max}[op](sides[0][1], sides[1][1]), sides[0][2] | sides[1][2], binds


def test_expressions_equal_their_trees(scanner):
    rng = random.Random(8)
    for _ in range(300):
        text, asks, families, _ = tree(rng, rng.randrange(5))
        assert licences.evaluate(licences.postfix(text)) == (families, licences.ASKS[asks]), text
        whole = f"# SPDX-License-Identifier: {text} */\nnext line or GPL-3.0"
        *same, labels, score = scanner.scan(whole)
        *plain, phrases, evidence = naive(whole)
        assert same == plain and 1 - score == (1 - evidence) / 4
        assert set(labels.split(",")) == families | {licences.ASKS[asks]} | set(filter(None, phrases.split(",")))


@pytest.mark.parametrize("line, order", [
    ("MIT", ["MIT"]), ("MIT or", ["MIT"]), ("MIT Apache-2.0", ["MIT"]), ("or MIT", []), ("", []), ("()", []), ("(MIT", []), ("MIT and (Apache-2.0 or", ["MIT"]),
    ("MIT) or GPL", ["MIT"]), ("a or b and c with d", ["a", "b", "c", "d", "!with", "!and", "!or"]), ("(a or b) and c", ["a", "b", "!or", "c", "!and"]),
    ("a or b or c", ["a", "b", "!or", "c", "!or"]), ("MIT -->", ["MIT", ]), ("MIT; or GPL", ["MIT"])])
def test_postfix_of_whole_and_broken_lines(line, order):
    assert [x for x in licences.postfix(line)] == order


def test_tags_in_many_places_and_long_texts(scanner):
    text = "word " * 400_000 + "\r\nSPDX_License identifier = x\n" + "Package-License-Declared: MIT\r# the license expression: (GPL-2.0 or BSD-2-Clause)\n" * 2000 + "mit license"
    n, n_base, first, last, base, labels, score = scanner.scan(text)
    assert (n_base, base, score) == (1, "mit", 1.0) and first == last == n - 2
    assert set(labels.split(",")) == {"mit", "gpl", "bsd", "asks-nothing-more"}


def test_whole_table_with_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None, 0), (2, "", 1), (3, "Released under the MIT License.", 2), (3, "Released under the MIT License.", 2), (None, "cc by cc by", 3), (4, "\x00 \n", 4)]
    df = spark.createDataFrame(rows, "doc_id int, text string, n_words int").withColumnRenamed("n_words", "score")
    got = sorted((tuple(r) for r in licences.scan(df).collect()), key=repr)
    assert got == sorted(((d, *naive(t or "")) for d, t, _ in rows), key=repr)
    assert licences.scan(df.limit(0)).collect() == []
