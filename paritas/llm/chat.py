"""Chat formatting from event logs.

A log has one row per event: ``conv_id, seq, kind, turn, role, text``. Kinds: ``message``
opens a turn with a role and a first text; ``delta`` appends to the turn's text; ``edit``
replaces the turn's text and drops all later turns; ``regenerate`` empties the turn and
drops all later turns, and later deltas fill it again.

1. Partition by conversation, sort by sequence. An event is dead when a later edit or
   regenerate names an earlier turn: one running minimum over the reversed log.
2. Fold what lives, in order of turn and sequence, as a stream over the sorted partition: a
   task holds one message at a time, so a conversation with a third of all rows needs no
   more memory than its longest message (its rows do go to one task: the digest of a
   conversation, like its text, has one order).
3. Render each message as one segment; a conversation is its segments in order. A text
   never contains a control string: a backslash is doubled, and a control string gets a
   backslash after its first character, which ``unescape`` takes out again. ``loss_start``
   and ``loss_end`` bound the assistant's escaped text inside the segment.

Defined cases: a null text is empty, a null role is the role ``unknown``; a null ``conv_id``
is a conversation of its own; events that share turn and sequence are ordered by kind and
text; a delta without a message opens a message of the role it carries; an empty log gives
no rows; texts of any length are cut in one pass; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paritas.llm.common import python_path

#: Strings with a meaning in the template or in common chat templates.
CONTROL = ["<|turn|>", "<|text|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
TURN, TEXT, END = CONTROL[:3]
_ESCAPED = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_SEGMENT = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.DOTALL)
LOG = "conv_id long, seq long, kind string, turn long, role string, text string"
SEGMENTS = "conv_id long, position long, segment string, loss_start long, loss_end long"


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """Segment of a message, and where its text carries loss."""
    head = TURN + escape(role) + TEXT
    body = escape(text)
    own = len(body) if role == "assistant" else 0
    return head + body + END, len(head), len(head) + own


def parse(segments: str) -> list[tuple[str, str]]:
    """(role, text) of each message of formatted text."""
    return [(unescape(r), unescape(t)) for r, t in _SEGMENT.findall(segments)]


def log_of(turns: DataFrame, delta_chars: int = 512) -> DataFrame:
    """The event log of finished turns (``conv_id, turn, role, text``): each row opens a message,
    in order of turn, role and text, and its text streams in by deltas."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", F.col("role"), F.coalesce("text", F.lit("")).alias("text"), F.row_number().over(order).cast("long").alias("at"))
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0))  # one pass, however long the text
    parts = F.transform(F.concat(F.array(F.lit("")), pieces), lambda t, k: F.struct(k.alias("k"), t.alias("t")))
    return (rows.select("conv_id", "role", "at", F.explode(parts).alias("p"))
            .select("conv_id", (F.col("at") * (1 << 24) + F.col("p.k")).alias("seq"), F.when(F.col("p.k") == 0, "message").otherwise("delta").alias("kind"),
                    F.col("at").alias("turn"), "role", F.col("p.t").alias("text")))


def _fold(batches):
    out: list[tuple] = []
    now, conv, at, role, parts = None, None, 0, "", []

    def close() -> None:
        if now is not None:
            segment, i, j = render(role, "".join(parts))
            out.append((conv, at, segment, i, j))

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out)) or [[]] * 5
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                                          ["conv_id", "position", "segment", "loss_start", "loss_end"])
        out.clear()
        return made

    for b in batches:
        for c, k, t, r, x in zip(*(b.column(n).to_pylist() for n in ("conv_id", "kind", "turn", "role", "text"))):
            if now != (c, t):
                close()
                at = at + 1 if now is not None and conv == c else 0
                now, conv, role, parts = (c, t), c, r or "unknown", []
            if k != "delta":  # opens, replaces or empties
                role, parts = r or role, []
            if k != "regenerate" and x:
                parts.append(x)
        yield batch()
    close()
    yield batch()


def format_log(log: DataFrame) -> DataFrame:
    """Rendered segments (``SEGMENTS``) of every conversation, sorted inside each partition, which
    holds whole conversations."""
    python_path(log.sparkSession)
    reset = F.when(F.col("kind").isin("edit", "regenerate"), F.col("turn"))
    later = Window.partitionBy("conv_id").orderBy(F.desc("seq"), F.desc("turn"), F.desc("kind"), F.desc("text")).rowsBetween(Window.unboundedPreceding, -1)
    alive = log.withColumn("cut", F.min(reset).over(later)).filter(F.col("cut").isNull() | (F.col("cut") >= F.col("turn")))
    alive = alive.select("conv_id", "seq", "kind", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "seq", F.desc("kind"), "text")
    return alive.mapInArrow(_fold, SEGMENTS)


def _digest(batches):
    conv, state, out = None, None, []

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out)) or [[]] * 6
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                                          ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
        out.clear()
        return made

    def close() -> None:
        if state is not None:
            out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

    for b in batches:
        for c, seg, i, j in zip(*(b.column(n).to_pylist() for n in ("conv_id", "segment", "loss_start", "loss_end"))):
            if state is None or c != conv:
                close()
                conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(seg):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            loss = unescape(seg[i:j])
            state[2] += len(loss)
            state[3].update(loss.encode())
            state[4] += len(seg)
        yield batch()
    close()
    yield batch()


def digests(segments: DataFrame) -> DataFrame:
    """Per conversation, read back from its segments: turns, their digest, the text under the loss
    mask and the formatted length."""
    return segments.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
