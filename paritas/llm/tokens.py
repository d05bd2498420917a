"""Whole-text encoding with the ``tokenizers`` library, used by packing and token files.

The split pattern of a byte-level vocabulary starts a new piece before white space that follows
something else, between a letter and a punctuation mark, and after a tab or line end that stands
alone; on either side of such a cut the match is the same. So whole texts are cut there, where the bytes
tell it (``_cuts``), every distinct piece is encoded by the library and remembered (a bounded
number of them) by the Python worker, and the ids of the pieces in order are the ids of the
whole text. Pieces, their places and their ids are Arrow arrays: Python sees new pieces only. These
go to the library as one string where that shows their borders: a token begins with a space only where
a piece begins, and a lone line end is a token of its own.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Longest piece that is remembered, how many pieces a worker remembers (about 60 bytes each), a byte-level vocabulary's space and line end.
PIECE_CHARS, PIECES, SPACE, LINE = 64, 250_000, "Ġ", "Ċ"
#: Bytes of text that are encoded at once, and pieces that go to the library as one string (it keeps some 200 bytes a token meanwhile).
TEXT_BYTES, JOINED = 2 << 20, 10_000
#: What ``str.isspace`` holds for white, as a class of Arrow's regular expressions.
_WHITE = r"\t-\r\x{1c}-\x{20}\x{85}\p{Z}"
_ENCODERS: dict[str, "Encoder"] = {}

_PLAIN, _MARK, _BLANK, _LETTER = 1, 2, 4, 8  # kinds of bytes: not white; punctuation; ASCII white space; ASCII letter
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _PLAIN
for _c in map(chr, range(0x21, 0x7F)):
    _KIND[ord(_c)] |= _LETTER if _c.isalpha() else 0 if _c.isdigit() else _MARK
_KIND[[*range(9, 14), 0x20]] = _BLANK


def _cuts(data: np.ndarray) -> np.ndarray:
    """For each of the UTF-8 bytes and the end: whether a new piece certainly begins there, whatever stands around."""
    kind = _KIND[data]
    at = np.flatnonzero(kind & (_MARK | _BLANK))
    at = at[at > 0]
    last, lead, third = data[at - 1], data[at - 2], data[np.maximum(at - 3, 0)]
    wide = last >= 0x80
    # Latin and Cyrillic letters of two bytes: U+00C0 to U+027F without two signs, U+0400 to U+047F.
    two = wide & (lead >= 0xC3) & ((lead <= 0xC9) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7))) | (lead == 0xD0) | (lead == 0xD1))
    letter = two | ((kind[at - 1] & _LETTER) > 0)
    # Not white: other characters of two bytes but those of 0xC2; of three but those of 0xE1, 0xE2 and 0xE3 0x80; of four.
    long = wide & (lead < 0xC0) & (third != 0xE1) & (third != 0xE2) & ~((third == 0xE3) & (lead == 0x80))
    plain = letter | ((kind[at - 1] & _PLAIN) > 0) | wide & (lead >= 0xC3) | long
    blank = (kind[at] & _BLANK) > 0
    found = at[np.where(blank, plain, letter)]
    lone = found[(kind[found] == _BLANK) & (data[found] != 0x20)] + 1
    lone = lone[lone < len(data)]
    after = data[lone]
    cuts = np.zeros(len(data) + 1, bool)
    cuts[found] = cuts[lone[((kind[lone] & _PLAIN) > 0) | (after >= 0xC3) & (after <= 0xC9)]] = True
    return cuts


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known = pa.array([], pa.string())
        self.known_ids = pa.array([], pa.list_(pa.int32()))
        self.asked, self.turn = np.zeros(0, np.int64), 0  # when each known piece was last asked for
        vocabulary = self.tokenizer.get_vocab()
        self.line = vocabulary.get(LINE, -1)
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)  # ids of tokens that begin with a space
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True

    def _ids(self, texts: list[str]) -> pa.ListArray:
        return pa.array([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)], pa.list_(pa.int32()))

    def _joined(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def _pieces(self, pieces: list[str]) -> pa.ListArray:
        """Ids of each piece, which has no white space, with a space before it."""
        ids = self._joined(" " + " ".join(pieces))
        at = np.flatnonzero(self.spaced[ids])
        if len(at) != len(pieces) or at[0]:
            return self._ids([" " + x for x in pieces])
        return pa.ListArray.from_arrays(np.append(at, len(ids)).astype(np.int32), ids)

    def _bare(self, pieces: list[str]) -> pa.ListArray:
        """Ids of each piece, which has no white space, as it is."""
        ids = self._joined("\n".join(pieces))
        at = np.flatnonzero(ids == self.line)
        if len(at) != len(pieces) - 1:
            return self._ids(pieces)
        ends = np.append(at, len(ids)) - np.arange(len(pieces))
        return pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), np.delete(ids, at))

    def _new(self, pieces: pa.StringArray) -> pa.ListArray:
        spaced = pc.match_substring_regex(pieces, f"^ [^{_WHITE}]+$").to_numpy(zero_copy_only=False)
        bare = pc.match_substring_regex(pieces, f"^[^{_WHITE}]+$").to_numpy(zero_copy_only=False)
        groups, order = [], []
        for rows, work in ((spaced, lambda x: self._pieces([s[1:] for s in x])), (bare, self._bare), (~(spaced | bare), self._ids)):
            if rows.any():
                order.append(np.flatnonzero(rows))
                some = pieces.filter(pa.array(rows))
                groups.extend(work(some.slice(i, JOINED).to_pylist()) for i in range(0, len(some), JOINED))
        return pa.concat_arrays(groups).take(pa.array(np.argsort(np.concatenate(order))))

    def _known(self, pieces: pa.StringArray) -> pa.ListArray:
        """Ids of each of the distinct pieces, from memory or the library. When more is remembered than may be, what was
        not asked for lately is forgotten."""
        self.turn += 1
        found = pc.index_in(pieces, value_set=self.known)
        fresh = found.is_null().to_numpy(zero_copy_only=False)
        at = found.fill_null(0).to_numpy().astype(np.int64)
        self.asked[at[~fresh]] = self.turn
        if not fresh.any():
            return self.known_ids.take(pa.array(at))
        at[fresh] = len(self.known) + np.arange(fresh.sum())
        new = pieces.filter(pa.array(fresh))
        new_ids = self._new(new)
        ids = pa.concat_arrays([self.known_ids, new_ids])
        short = pc.less_equal(pc.utf8_length(new), PIECE_CHARS)
        self.known = pa.concat_arrays([self.known, new.filter(short)])
        self.known_ids = pa.concat_arrays([self.known_ids, new_ids.filter(short)])
        self.asked = np.append(self.asked, np.full(len(self.known) - len(self.asked), self.turn))
        if len(self.known) > PIECES:
            keep = np.argsort(-self.asked, kind="stable")[: PIECES // 2]
            self.known, self.known_ids, self.asked = self.known.take(pa.array(keep)), self.known_ids.take(pa.array(keep)), self.asked[keep]
        return ids.take(pa.array(at))

    def encode_array(self, texts: pa.Array, end_id: int) -> pa.ListArray:
        """Ids of each text (null: empty) and ``end_id`` after them."""
        texts = texts.cast(pa.string()).fill_null("")
        _, places, data = texts.buffers()
        borders = np.frombuffer(places, np.int32)[texts.offset: texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
        size = int(borders[-1] - borders[0])
        whole = np.frombuffer(data, np.uint8)[borders[0]: borders[-1]] if size else np.zeros(0, np.uint8)
        borders = borders - borders[0]
        begins = _cuts(whole)
        begins[borders] = True
        cuts = np.flatnonzero(begins).astype(np.int32)
        before = np.searchsorted(cuts, borders)  # pieces before each text
        pieces = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(whole)).dictionary_encode()
        ids = self._known(pieces.dictionary)
        ids = pa.concat_arrays([ids, pa.array([[end_id]], pa.list_(pa.int32()))])
        rows = np.insert(pieces.indices.to_numpy(), before[1:], len(ids) - 1)
        spelled = ids.take(pa.array(rows))
        at = spelled.offsets.to_numpy()[before + np.arange(len(before))]
        return pa.ListArray.from_arrays(pa.array(at - at[0]), spelled.flatten())

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        """Ids of each text and ``end_id`` after them, as little-endian unsigned 32-bit numbers."""
        ids = self.encode_array(pa.array(texts, pa.string()), end_id)
        flat, at = ids.flatten().to_numpy().astype("<u4"), ids.offsets.to_numpy()
        return [flat[i:j].tobytes() for i, j in zip(at, at[1:])]


def encoder(path: str) -> Encoder:
    """The worker's encoder of that vocabulary file; it lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def gathered(batches, column: str = "text", size: int = TEXT_BYTES):
    """Arrow batches in order, cut and put together to about ``size`` bytes of ``column``: few enough that a task holds the
    ids of few texts at once, many enough that a word they share is looked up once."""
    held, held_bytes = [], 0
    for batch in batches:
        for b in in_slices([batch]):
            held.append(b)
            held_bytes += b.column(column).nbytes
            if held_bytes >= size:
                yield pa.concat_batches(held)
                held, held_bytes = [], 0
    if held:
        yield pa.concat_batches(held)


def in_slices(batches, rows: int = 500):
    """Arrow batches cut to at most ``rows`` rows, so a task holds the ids of few texts at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_piece_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
