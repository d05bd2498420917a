"""Licence scans: Aho-Corasick over words, shunting-yard over licence expressions.

1. A text is lower-cased (A-Z) and cut into words; the words, one space between them, are
   read once by an Aho-Corasick automaton of all phrases at once: licence names, notice
   phrases and identifier tags (``SPDX-License-Identifier:`` and the like). Overlapping
   places all count.
2. Behind an identifier tag the rest of the line is a licence expression. A shunting-yard
   parser turns ``and``, ``or`` and ``with`` (any case, ``with`` binds tightest, then
   ``and``, then ``or``) and brackets into postfix order, which is evaluated to
   how much the licence asks of a user: ``or`` leaves the choice, so the least demanding side
   counts, ``and`` the most demanding, ``with`` an exception makes a copyleft licence a weak
   one. The expression is the longest beginning of the line that is one with its brackets closed, so a
   comment's end behind it does no harm; a line that begins with none has no labels.
3. Labels: the base phrases' own; those of the method's phrases; for each identifier of an
   expression its family (``mit``, ``gpl``, ...; an unknown one ``other``) and for the
   expression what it asks (``asks-nothing-more`` ... ``asks-unknown``). ``score`` is
   ``1 - 0.5 ** (phrases + 2 * expressions)``: 0 without evidence, nearer to 1 with each place.

How it runs: one pass over the text in Arrow batches, no shuffle; a document is a row, so
nothing is grouped. The automaton is built once per task from the fixed phrases below.

Defined cases: a null text is empty; an empty text has no words, null places, empty labels
and score 0; texts of any length are read whole, in time linear in them; repeated rows stay,
a null ``doc_id`` stays null; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from paritas.llm.common import python_path

#: Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Phrases of the method.
PHRASES = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl", "mozilla public license": "mpl",
    "eclipse public license": "epl", "bsd license": "bsd", "boost software license": "bsl", "isc license": "isc",
    "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc0": "cc0", "creative commons attribution": "cc-by",
    "public domain": "public-domain", "all rights reserved": "all-rights-reserved", "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under": "notice", "released under": "notice",
}
#: Tags that an expression follows, as words.
TAGS = ("spdx license identifier", "license expression", "package license declared", "package license concluded")
#: Family of an identifier by its first words, and what the family asks (index into ASKS).
FAMILIES = {
    "agpl": 2, "lgpl": 1, "gpl": 2, "mpl": 1, "epl": 1, "apache": 0, "mit": 0, "bsd": 0, "isc": 0, "bsl": 0, "zlib": 0, "unlicense": 0,
    "cc0": 0, "cc-by-nc": 3, "cc-by-nd": 3, "cc-by-sa": 2, "cc-by": 0,
}
ASKS = ("asks-nothing-more", "asks-weak-copyleft", "asks-copyleft", "asks-unknown")
UNKNOWN, WEAK = 3, 1
BINDS = {"or": 1, "and": 2, "with": 3}

SCANNED = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
_NAMES = [x.split(" ")[0] for x in SCANNED.split(", ")]
_TYPES = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
#: Bytes of words as they are, A-Z in lower case, all others a space.
_AS_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
_LINE = re.compile(rb"[^\r\n]*")
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9.+:-]+)")


def tokens(line: str):
    """Brackets and words of an expression as far as the line has nothing else."""
    at = 0
    while found := _TOKEN.match(line, at):
        yield found[1]
        at = found.end()


def postfix(line: str) -> list[str]:
    """The expression at the beginning of ``line`` in postfix order: identifiers as they are,
    operators in lower case with a ``!`` before them; empty without one."""
    out: list[str] = []
    held: list[str] = []
    whole: list[str] = []  # the longest beginning that is an expression with its brackets closed
    operand = True
    for token in tokens(line):
        word = token.lower()
        if operand and token == "(":
            held.append("(")
        elif operand and token != ")" and word not in BINDS:
            out.append(token)
            operand = False
        elif not operand and token == ")" and "(" in held:
            while (top := held.pop()) != "(":
                out.append("!" + top)
        elif not operand and word in BINDS:
            while held and held[-1] != "(" and BINDS[held[-1]] >= BINDS[word]:
                out.append("!" + held.pop())
            held.append(word)
            operand = True
        else:
            break
        if not operand and "(" not in held:
            whole = out + ["!" + x for x in reversed(held)]
    return whole


def family(identifier: str) -> str:
    """The longest family that begins the identifier, up to a word end; else ``other``."""
    name = identifier.lower()
    return max((f for f in FAMILIES if name == f or name.startswith((f + "-", f + "+", f + "."))), key=len, default="other")


def evaluate(order: list[str]) -> tuple[set[str], str]:
    """Families named by a postfix expression and what it asks. What stands after ``with`` is
    an exception, not a licence."""
    stack: list[tuple[int, set[str]]] = []
    for item in order:
        if item == "!with":
            stack.pop()
            asks, named = stack.pop()
            stack.append((min(asks, WEAK) if asks != UNKNOWN else asks, named))
        elif item[0] == "!":
            (b, y), (a, x) = stack.pop(), stack.pop()
            stack.append(((min if item == "!or" else max)(a, b), x | y))
        else:
            f = family(item)
            stack.append((FAMILIES.get(f, UNKNOWN), {f}))
    (asks, named), = stack
    return named, ASKS[asks]


class Scanner:
    """The automaton of all phrases and tags, each between spaces."""

    def __init__(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for kind, phrases in (("base", BASE), ("method", PHRASES), ("tag", dict.fromkeys(TAGS, ""))):
            for phrase, label in phrases.items():
                words = phrase.split(" ")
                self.automaton.add_word(f" {phrase} ", (kind, label, len(words)))
        self.automaton.make_automaton()

    def scan(self, text: str) -> tuple:
        """``n_words, n_base, first_word, last_word, base_labels, labels, score``."""
        raw = text.encode("utf-8", "surrogatepass")
        words = raw.translate(_AS_WORDS).split()
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        places: list[int] = []
        base: set[str] = set()
        labels: set[str] = set()
        evidence, counted, at, tags = 0, 0, 0, []
        for end, (kind, label, n) in self.automaton.iter(line):
            counted, at = counted + line.count(" ", at, end), end  # words that end before the last space of this place
            if kind == "tag":
                tags.append(counted)
                continue
            evidence += 1
            labels.add(label)
            if kind == "base":
                places.append(counted - n)
                base.add(label)
        for order in map(postfix, self._behind(raw, tags)):
            if order:
                named, asks = evaluate(order)
                labels |= named | {asks}
                evidence += 2
        return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 - 0.5 ** evidence)

    @staticmethod
    def _behind(raw: bytes, after: list[int]):
        """The rest of the line behind the first ``k`` words, for each ``k``, without a leading colon."""
        if not after:
            return
        wanted, last = set(after), max(after)
        for k, word in enumerate(_WORD.finditer(raw), 1):
            if k in wanted:
                yield _LINE.match(raw, word.end())[0].decode("utf-8", "replace").lstrip(" \t\":'")
            if k == last:
                return


def _scan(batches):
    scanner = Scanner()
    for b in batches:
        rows = [scanner.scan(t) if t else (0, 0, None, None, "", "", 0.0) for t in b.column("text").to_pylist()]
        cols = list(zip(*rows)) or [[]] * 7
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, _TYPES[1:])]], _NAMES)


def scan(docs: DataFrame) -> DataFrame:
    """``SCANNED`` of every row of ``docs(doc_id, text)``."""
    python_path(docs.sparkSession)
    return docs.selectExpr("cast(doc_id as long) AS doc_id", "cast(text as string) AS text").mapInArrow(_scan, SCANNED)
