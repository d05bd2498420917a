"""Conversation repair against full searches on small conversations."""

import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from paritas.llm import repair

SOUND = re.compile(r"(s?(ua)+)?\Z")
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(WHITE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def searched(rows):
    """Cost, audit and rows of the cheapest edits, trying all of them: at each gap up to two insertions (three
    lead no further than one), at each row every edit."""
    marks, best = faults(rows), None
    gaps = [("",), *[("I", r) for r in ("user", "assistant")], *[("II", a, b) for a, b in itertools.product(("user", "assistant"), repeat=2)]]
    choices = []
    for (role, text), mark in zip(rows, marks):
        extra, one = 3 * (mark == "truncated"), [(4, "D", None)]
        if mark not in ("blank", "duplicate"):
            one += [(extra, "K", role), (3 + extra, "R", "user"), (3 + extra, "R", "assistant")]
        choices.append(one)
    for edits in itertools.product(*choices):
        for inserts in itertools.product(gaps, repeat=len(rows) + 1):
            cost = sum(e[0] for e in edits) + 3 * sum(len(g) - 1 for g in inserts)
            if best is not None and cost > best[0]:
                continue
            audit, made = "", []
            for k, gap in enumerate(inserts):
                audit, made = audit + gap[0], made + [(r, "") for r in gap[1:]]
                if k < len(rows):
                    audit += edits[k][1]
                    if edits[k][2] is not None:
                        made.append((edits[k][2], rows[k][1]))
            if SOUND.match("".join(r[:1] or "-" for r, _ in made)):
                best = min(best or (cost, audit, made), (cost, audit, made), key=lambda x: x[:2])
    return best


def parsed(rows):
    spans = repair.Spans()
    for (role, _), mark in zip(rows, faults(rows)):
        spans.add(repair.row_cell(role[:1], mark == "truncated", mark in ("blank", "duplicate")))
    return repair.cheapest(spans.cell())


def test_cells_find_the_cheapest_edits_of_all():
    rng = random.Random(3)
    for n in (0, 1, 2, 3):
        for _ in range(25):
            rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["a.", "b!", "c", " ", "", "d?"])) for _ in range(n)]
            cost, audit, made = searched(rows)
            assert parsed(rows) == (cost, audit)
            assert repair.repaired_rows(rows, audit) == made


def test_every_split_of_a_span_gives_the_same_cell():
    rng = random.Random(5)
    cells = [repair.row_cell(rng.choice("suat"), rng.random() < 0.3, rng.random() < 0.2) for _ in range(9)]

    def cell(i, j):
        if j - i == 1:
            return cells[i]
        found = {repair.combine(cell(i, k), cell(k, j)) for k in range(i + 1, j)}
        assert len(found) == 1
        return found.pop()

    spans = repair.Spans()
    for c in cells:
        spans.add(c)
    assert cell(0, len(cells)) == spans.cell()


def forward(rows):
    """Least (cost, audit) by states, row by row: a second way for long conversations."""
    def closed(best):
        for _ in range(4):
            for p, (c, a) in list(best.items()):
                for i in "ua":
                    if p in repair.STEP[i]:
                        q = repair.STEP[i][p]
                        best[q] = min(best.get(q, (c + 3, a + "I")), (c + 3, a + "I"))
        return best

    best = closed({0: (0, "")})
    for (role, _), mark in zip(rows, faults(rows)):
        after = {}
        for p, (c, a) in best.items():
            options = [(p, c + 4, a + "D")]
            if mark not in ("blank", "duplicate"):
                c += 3 * (mark == "truncated")
                options += [(repair.STEP[i][p], c + 3, a + "R") for i in "ua" if p in repair.STEP[i]]
                if p in repair.STEP.get(role[:1], {}):
                    options.append((repair.STEP[role[:1]][p], c, a + "K"))
            for q, cost, audit in options:
                after[q] = min(after.get(q, (cost, audit)), (cost, audit))
        best = closed(after)
    return min(best[q] for q in (0, 3) if q in best)


def expected(rows):
    """The contract's row of one conversation from its rows in order: (turn, role, text)."""
    said = [(r, t) for _, r, t in rows]
    marks, turns = faults(said), {t for t, _, _ in rows if t is not None}
    cost, audit = forward(said) if rows else (0, "")
    made = repair.repaired_rows(said, audit)
    pairs = zip([r[:1] for r, _ in said], [r[:1] for r, _ in said][1:])
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, marks.count("blank"), marks.count("duplicate"), marks.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in pairs), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        one = lambda v: " " if v is None else str(v)
        k, role, text = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20, one(role), one(text)
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def brute(rows):
    out, after = {}, damaged(rows)
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in after if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        out[conv] = expected(mine)
    return out


def run(df):
    found = repair.repair(repair.damage(df), df.select("conv_id")).collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r)[1:] for r in found}


def test_whole_table_with_nulls_ties_repeats_and_clashing_names(spark):
    rng = random.Random(9)
    rows = []
    for conv in [*range(60), None]:
        for turn in [None, *range(rng.randrange(0, 9))]:
            if turn is None and rng.random() < 0.6:
                continue
            for _ in range(rng.choice([1, 1, 1, 2])):  # ties and repeated rows
                rows.append((conv, turn, rng.choice(["system", "user", "assistant", "user", "assistant", "admin", "", None]),
                             rng.choice(["One.", "Two!", "three", "", " \t", None, "Done?\n", "ü!"])))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, cost int, digest string")
    assert run(df) == brute(rows)


def test_a_conversation_over_many_tasks_and_long_texts(spark):
    rng = random.Random(2)
    rows = [(7, k, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", f"{k}!", ""])) for k in range(3000)]
    rows += [(8, k, "user" if k % 2 == 0 else "assistant", "long " * 200_000 + ".") for k in range(3)]
    rows += [(c, 0, "user", "Hi.") for c in range(100, 140)]  # sound but for the missing answer, or dropped
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark.createDataFrame(rows, repair.ROWS).repartition(8)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table_and_conversations_that_lost_all_rows(spark):
    assert run(spark.createDataFrame([], repair.ROWS)) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark.createDataFrame([(gone, 0, "user", "Hi.")], repair.ROWS)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
