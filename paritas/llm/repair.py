"""Conversation structure repair by weighted CYK interval parsing.

Roles of a sound conversation spell ``(s?(ua)+)?`` in initials. The repair grammar is in
Chomsky normal form: a nonterminal ``pq`` says that the rows of a span, after edits, lead the
pattern from state ``p`` to state ``q`` (``0`` start, ``1`` after s, ``2`` after u, ``3``
after a). ``pq -> pr rq`` joins two spans; ``pq -> row`` are the edits of one row: keep (0),
rerole to user or assistant (3), delete (4, the only edit of a blank or repeated row); a
truncated row that is not deleted adds 3. Insertions (3 each, a user or an assistant row
without text) need no row, so each cell is closed under them on both sides. A cell holds the
least ``(cost, audit)``, the audit being the edits' initials in order.

Because every state may stand between two spans, each way to split a span derives the same
cell; so a span is split once, in the middle, and cells are combined bottom-up by span
length: linear in the rows. Least audits may be joined: two audits of one span and one cost
name the same rows, the longer could only have more insertions, which cost, so neither
begins with the other.

How it runs: facts of a row (initial, faults, a digest of the text) are computed by Spark
and move without the text. Equal rows become one row with a count before the search for
earlier equals, which is a grouped minimum joined back. The facts are range-partitioned by
conversation and turn, so a conversation with a third of all rows is spread over many tasks,
each of which returns one cell per span of a conversation; spans are then joined in order.
The texts move once: audits and rows are sorted by conversation and streamed, one row in
memory, into the digest of the repaired text (a digest has one order, so a conversation's
rows go to one task there; its audit is one string and is in memory as a whole).

Defined cases: nulls are one space, in the damage's key as in roles and texts, except that a
null turn comes first and does not count in ``gaps``; a null conversation is one of its own;
an initial is the role's first character, an empty role has none and can only be reroled or
deleted; rows of one turn are ordered by role and by the text's digest; a conversation whose rows
are all dropped, and one without any kept row, has the digest of the empty string; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import python_path, written

STATES = range(4)
START, ACCEPT = 0, (0, 3)
#: Where an initial leads from each state, the cost of each edit, the roles a row may get.
STEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FULL = {"u": "user", "a": "assistant"}
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"

Cell = tuple  # 16 entries (cost, audit) or None, by 4 * from + to

ROWS = "conv_id long, turn long, role string, text string"
SPANS = ("conv_id long, part int, n_rows long, blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, "
         "least_turn long, greatest_turn long, turns long, cell_costs array<long>, cell_audits array<string>")
REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two spans that follow each other."""
    out = []
    for p in STATES:
        for q in STATES:
            best = None
            for r in STATES:
                x, y = left[4 * p + r], right[4 * r + q]
                if x is None or y is None:
                    continue
                cost = x[0] + y[0]
                if best is None or cost < best[0] or (cost == best[0] and x[1] + y[1] < best[1]):
                    best = (cost, x[1] + y[1])
            out.append(best)
    return tuple(out)


def _least(cells: list[dict]) -> Cell:
    """Entry by entry the least of ``{(p, q): (cost, audit)}``."""
    return tuple(min((c[p, q] for c in cells if (p, q) in c), default=None) for p in STATES for q in STATES)


def _insertions() -> Cell:
    stay = {(p, p): (0, "") for p in STATES}
    one = {(p, q): (INSERT, "I") for i in "ua" for p, q in STEP[i].items()}
    closed = once = _least([stay, one])
    while (further := combine(closed, once)) != closed:
        closed = further
    return closed


#: The cell of a span without rows: insertions only.
NOTHING = _insertions()


@lru_cache(maxsize=256)
def row_cell(initial: str, truncated: bool, dead: bool) -> Cell:
    """The cell of one row; a ``dead`` row can only be deleted."""
    edits = [{(p, p): (DELETE, "D") for p in STATES}]
    if not dead:
        extra = TRUNCATED * truncated
        edits.append({(p, q): (extra, "K") for p, q in STEP.get(initial, {}).items()})
        edits += [{(p, q): (REROLE + extra, "R") for p, q in STEP[i].items()} for i in "ua"]
    return combine(combine(NOTHING, _least(edits)), NOTHING)


class Spans:
    """Cells of a growing row of spans, combined bottom-up: two spans become one when they are
    equally long, so each row takes part in as many combinations as its span was doubled."""

    def __init__(self) -> None:
        self.stack: list[tuple[int, Cell]] = []

    def add(self, cell: Cell, length: int = 1) -> None:
        while self.stack and self.stack[-1][0] <= length:
            n, before = self.stack.pop()
            cell, length = combine(before, cell), n + length
        self.stack.append((length, cell))

    def cell(self) -> Cell:
        out = None
        for _, c in reversed(self.stack):
            out = c if out is None else combine(c, out)
        return NOTHING if out is None else out


def cheapest(cell: Cell) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    return min(x for x in (cell[4 * START + q] for q in ACCEPT) if x is not None)


def legal(before: str, after: str) -> bool:
    """Whether two initials may stand side by side: su, ua, au."""
    return (before, after) in (("s", "u"), ("u", "a"), ("a", "u"))


def damage(rows: DataFrame) -> DataFrame:
    """``ROWS`` with planted faults, by ``crc32("conv_id:turn") % 20``: 0 drops the row, 1
    empties its text, 2 takes out its ``.!?``, 3 repeats it, 4 makes its role user."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    out = rows.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), (F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn"))) % 20).alias("fault"))
    out = out.filter("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return out.drop("copy")


def facts(rows: DataFrame) -> DataFrame:
    """One row per different ``(conv_id, turn, role, text)``: ``digest`` of the text, ``n`` equal
    rows, ``initial``, the faults of the first of them (``blank``, ``duplicate`` when role and
    text stood in an earlier turn, ``truncated``). The text is read here and not moved."""
    bare = F.rtrim("text", F.lit(WHITE))
    said = rows.select("conv_id", "turn", "role", F.sha2("text", 256).alias("digest"),
                       (bare == "").alias("blank"), (~bare.rlike(r"[.!?]\z")).alias("truncated"))
    keys = ["conv_id", "role", "digest"]
    said = said.groupBy(*keys, "turn").agg(F.count("*").alias("n"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    earliest = said.groupBy(*keys).agg(F.min(when).alias("earliest"), F.count("*").alias("different")).filter("different > 1").drop("different")
    earliest = earliest.select(*[F.col(k).alias(f"e_{k}") for k in keys], "earliest")
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"e_{k}"))
    marked = said.join(earliest, same, "left")
    return marked.select("conv_id", "turn", "role", "digest", "n", F.substring("role", 1, 1).alias("initial"), "blank", "truncated",
                         (F.col("earliest").isNotNull() & ~F.col("earliest").eqNullSafe(when)).alias("duplicate"))


def _order(*more: str):
    return [F.col("conv_id").asc_nulls_first(), *[F.col(c) for c in more], F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


_SPAN_NAMES = [x.split(" ")[0] for x in SPANS.split(", ")]
_SPAN_TYPES = [pa.int64(), pa.int32()] + [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.list_(pa.string())]


def _spans(batches):
    """One ``SPANS`` row per conversation of a sorted partition."""
    part, now, has = TaskContext.get().partitionId(), None, False
    out: list[tuple] = []

    def close() -> None:
        if has:
            cell = spans.cell()
            out.append((now, part, n, *[count[c] for c in _COUNTS], first, last, low, high, turns,
                        [None if x is None else x[0] for x in cell], [None if x is None else x[1] for x in cell]))

    for b in batches:
        for c, turn, n_equal, initial, blank, truncated, duplicate in zip(*(b.column(x).to_pylist() for x in ("conv_id", "turn", "n", "initial", "blank", "truncated", "duplicate"))):
            if not has or c != now:
                close()
                now, has, spans, n, count = c, True, Spans(), 0, dict.fromkeys(_COUNTS, 0)
                first, last, low, high, turns = initial, None, None, None, 0
            if turn is not None and turn != high:
                low, high, turns = turn if low is None else low, turn, turns + 1
            for k in range(n_equal):
                repeated = duplicate or k > 0
                fault = "blank" if blank else "duplicate" if repeated else "truncated" if truncated else None
                if fault:
                    count[fault] += 1
                count["illegal"] += last is not None and not legal(last, initial)
                spans.add(row_cell(initial, fault == "truncated", fault in ("blank", "duplicate")))
                last, n = initial, n + 1
        yield _batch(out, _SPAN_NAMES, _SPAN_TYPES)
        out.clear()
    close()
    yield _batch(out, _SPAN_NAMES, _SPAN_TYPES)


_FOUND = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_FOUND_NAMES = [x.split(" ")[0] for x in _FOUND.split(", ")]
_FOUND_TYPES = [pa.int64()] * 7 + [pa.string()]


def _joined(batches):
    """One ``_FOUND`` row per conversation from its spans in order."""
    now, has = None, False
    out: list[tuple] = []

    def close() -> None:
        if has:
            cost, audit = cheapest(spans.cell())
            out.append((now, 0 if low is None else high - low + 1 - turns, *[count[c] for c in _COUNTS], cost, audit))

    for b in batches:
        for row in b.to_pylist():
            if not has or row["conv_id"] != now:
                close()
                now, has, spans, count = row["conv_id"], True, Spans(), dict.fromkeys(_COUNTS, 0)
                last, low, high, turns = None, None, None, 0
            spans.add(tuple(None if c is None else (c, a) for c, a in zip(row["cell_costs"], row["cell_audits"])), row["n_rows"])
            for c in _COUNTS:
                count[c] += row[c]
            count["illegal"] += last is not None and not legal(last, row["first_initial"])
            last = row["last_initial"]
            if row["least_turn"] is not None:
                turns += row["turns"] - (row["least_turn"] == high)
                low, high = row["least_turn"] if low is None else low, row["greatest_turn"]
        yield _batch(out, _FOUND_NAMES, _FOUND_TYPES)
        out.clear()
    close()
    yield _batch(out, _FOUND_NAMES, _FOUND_TYPES)


def parse(rows: DataFrame) -> DataFrame:
    """``conv_id``, counts of faults, ``cost`` and ``audit`` of every conversation in ``ROWS``."""
    python_path(rows.sparkSession)
    known = written(facts(rows))
    spread = known.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    spans = spread.select("conv_id", "turn", "n", "initial", "blank", "truncated", "duplicate").mapInArrow(_spans, SPANS)
    order = [F.col("conv_id").asc_nulls_first(), F.col("part")]
    return spans.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_joined, _FOUND)


class Replay:
    """Applies an audit to rows in order: the repaired rows."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _given(self, text: str) -> tuple[str, str]:
        """An inserted or reroled row: from each state one of user and assistant goes on."""
        initial = next(i for i in "ua" if self.state in STEP[i])
        self.state = STEP[initial][self.state]
        return FULL[initial], text

    def inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._given("")

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = STEP[role[:1]][self.state]
            yield role, text
        elif edit == "R":
            yield self._given(text)


_NAMES = [x.split(" ")[0] for x in REPAIRED.split(", ")]
_TYPES = [pa.int64()] * 7 + [pa.string()] * 2
_ORIGINAL, _AUDIT, _TEXT = 0, 1, 2


def _digests(batches):
    now, has = None, False
    out: list[tuple] = []

    def say(rows) -> None:
        nonlocal n
        for role, text in rows:
            digest.update(("\n" if n else "").encode() + f"{role}:{text}".encode())
            n += 1

    def close() -> None:
        if has:
            if replay is not None:
                say(replay.inserted())
            out.append((now, *found, digest.hexdigest()))

    for b in batches:
        for c, kind, role, text, *facts_ in zip(*(b.column(x).to_pylist() for x in ("conv_id", "kind", "role", "text", *_FOUND_NAMES[1:]))):
            if not has or c != now:
                close()
                now, has, replay, found, digest, n = c, True, None, (0,) * 6 + ("",), hashlib.sha256(), 0
            if kind == _AUDIT:
                found, replay = tuple(facts_), Replay(facts_[-1])
            elif kind == _TEXT:
                say(replay.row(role, text))
        yield _batch(out, _NAMES, _TYPES)
        out.clear()
    close()
    yield _batch(out, _NAMES, _TYPES)


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """``REPAIRED`` of every conversation in ``rows`` (``ROWS``) and of those that only
    ``conversations`` (a ``conv_id`` column) names."""
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    found = parse(rows)
    named = rows if conversations is None else conversations
    named = named.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("kind", F.lit(_ORIGINAL))
    texts = rows.select("conv_id", F.lit(_TEXT).alias("kind"), "turn", "role", F.sha2("text", 256).alias("digest"), "text")
    both = named.unionByName(found.withColumn("kind", F.lit(_AUDIT)), allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions(*_order("kind"))
    return ordered.select("conv_id", "kind", "role", "text", *_FOUND_NAMES[1:]).mapInArrow(_digests, REPAIRED)


def repaired_rows(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The rows ``(role, text)`` of one conversation after its audit."""
    replay, out = Replay(audit), []
    for role, text in rows:
        out += replay.row(role, text)
    return out + list(replay.inserted())
