"""Texts to token ids with a tokenizer file, inside tasks.

A byte-level BPE never merges across the place before a single space that stands between
two other characters, nor across a single line break between two, nor from an ASCII letter
or digit to a mark other than the apostrophe, so a text is cut there and each distinct piece
is encoded once as long as a worker remembers it. Texts with other white space around their
spaces, or with a token that was added to the vocabulary (such as an end mark), are encoded
whole. The ids are those of the library either way (tests compare). Cutting, telling pieces
apart and laying their ids end to end is done on Arrow columns; Python sees the distinct
pieces of a column only.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of the pieces a worker remembers, with what they cost beside their text and ids.
REMEMBERED_BYTES = 448 << 20
ENTRY_BYTES = 200
# Bytes of the new pieces in one call of the library.
CALL_BYTES = 1 << 20
# Text that is encoded at once, in bytes.
COLUMN_BYTES = 1 << 20
# How the vocabulary writes the space before a word.
SPACE_MARK = "Ġ"
# Kinds of ASCII characters, by byte.
SPACE, LINE_BREAK = 0x20, 0x0A
WHITE_BYTES, WORD_BYTES, MARK_BYTES = np.array(
    [(c.isspace(), c.isalnum(), c.isprintable() and not c.isalnum() and c not in " '") for c in map(chr, range(128))] + [(False,) * 3] * 128
).T.copy()


class Encoder:
    """Encodes texts into little-endian bytes of unsigned 16 or 32 bit ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.type = np.dtype("<u2" if self.width == 2 else "<u4")
        self.end = np.zeros(1, self.type).tobytes()
        self.spaced = np.zeros(size, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.spaced[number] = token.startswith(SPACE_MARK)
        self.line_break = self._ids("\n")
        self.broken = np.zeros(size, bool)
        self.broken[np.frombuffer(self.line_break, self.type)] = True
        # ids of pieces, each with the space or line break before it
        self.seen: dict[bytes, bytes] = {}
        self.held = 0

    def _bytes(self, ids: list[int]) -> bytes:
        return array("H" if self.width == 2 else "I", ids).tobytes()

    def _ids(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _learn(self, pieces: list[bytes]) -> None:
        """Remember the ids of new pieces, but for those that can't be encoded alone."""
        spaced: list[bytes] = []
        broken: list[bytes] = []
        alone: list[bytes] = []
        for piece in pieces:
            text = piece.decode()
            inner = text[1:] if text[0] in " \n" else text
            # white space on either side of a cut: there a merge may reach across
            if not inner or inner != inner.strip():
                continue
            if text[0] == " ":
                spaced.append(piece)
            else:
                (alone if "\n" in inner else broken).append(piece)
            self.held += 3 * len(piece) + ENTRY_BYTES
        self.seen.update(zip(spaced, self._ids_of_each(spaced, self.spaced)))
        lines = [piece if piece.startswith(b"\n") else b"\n" + piece for piece in broken]
        skip = len(self.line_break)
        for piece, ids in zip(broken, self._ids_of_each(lines, self.broken)):
            self.seen[piece] = ids if piece.startswith(b"\n") else ids[skip:]
        self.seen.update(zip(alone, self._ids_alone(alone)))

    def _ids_alone(self, pieces: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([piece.decode() for piece in pieces], add_special_tokens=False)
        return [self._bytes(x.ids) for x in found]

    def _ids_of_each(self, pieces: list[bytes], begins: np.ndarray) -> Iterator[bytes]:
        """Ids of pieces, some of them in each call; `begins` tells the ids that a piece begins with."""
        some: list[bytes] = []
        size = 0
        for n, piece in enumerate(pieces, 1):
            some.append(piece)
            size += len(piece)
            if size < CALL_BYTES and n < len(pieces):
                continue
            raw = self._ids(b"".join(some).decode())
            starts = np.flatnonzero(begins[np.frombuffer(raw, self.type)]) * self.width
            if len(starts) == len(some):
                cuts = [*starts.tolist(), len(raw)]
                yield from [raw[a:b] for a, b in zip(cuts, cuts[1:])]
            else:  # some piece has such an id within
                yield from self._ids_alone(some)
            some, size = [], 0

    def _in_pieces(self, texts: pa.LargeStringArray, breaks: bool) -> list[bytes | None]:
        """Ids of each text from those of its pieces; None for one that can't be cut so.

        Texts are cut before spaces and marks and, with `breaks`, before line breaks without white space beside them.
        """
        _, offsets, values = texts.buffers()
        ends = np.frombuffer(offsets, "<i8")[texts.offset : texts.offset + len(texts) + 1]
        if ends[0] == ends[-1]:
            return [b""] * len(texts)
        values = values.slice(int(ends[0]), int(ends[-1] - ends[0]))
        ends = ends - ends[0]
        chars = np.frombuffer(values, np.uint8)
        cut = chars == SPACE
        cut[1:] |= WORD_BYTES[chars[:-1]] & MARK_BYTES[chars[1:]]
        if breaks:
            at = np.flatnonzero(chars[1:-1] == LINE_BREAK) + 1
            cut[at[~(WHITE_BYTES[chars[at - 1]] | WHITE_BYTES[chars[at + 1]])]] = True
        cut[ends[:-1][ends[:-1] < len(chars)]] = True
        starts = np.flatnonzero(cut)
        bounds = np.searchsorted(starts, ends)
        places = pa.py_buffer(np.append(starts, len(chars)).astype("<i8"))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, places, values]).dictionary_encode()
        keys = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.seen.get, keys))
        new = [n for n, ids in enumerate(known) if ids is None]
        self._learn([keys[n] for n in new])
        for n in new:
            known[n] = self.seen.get(keys[n])
        found = pa.array(known, pa.large_binary())
        ids = found.take(pieces.indices)
        cuts = np.frombuffer(ids.buffers()[1], "<i8")[bounds].tolist()
        raw = ids.buffers()[2].to_pybytes() if cuts[-1] else b""
        out: list[bytes | None] = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        if found.null_count:
            unclean = np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False))
            for n in set((np.searchsorted(bounds, unclean, "right") - 1).tolist()):
                out[n] = None
        return out

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """For each text its ids and the end id 0; null is as empty."""
        if self.held > REMEMBERED_BYTES:
            self.seen, self.held = {}, 0
        texts = texts.cast(pa.large_string()).fill_null("")
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        out: list[bytes | None] = [None] * len(texts)
        left = np.flatnonzero(~whole)
        for breaks in (True, False):
            found = self._in_pieces(texts.take(pa.array(left)) if len(left) < len(texts) else texts, breaks) if len(left) else []
            for n, ids in zip(left.tolist(), found):
                out[n] = ids
            left = left[[ids is None for ids in found]]
        return [(self._ids(texts[n].as_py()) if ids is None else ids) + self.end for n, ids in enumerate(out)]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """As `encode_column`, of a list."""
        return self.encode_column(pa.array(texts, pa.large_string()))

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text, and the end id 0."""
        return self.encode_all([text])[0]

    def encode_batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
        """(doc_id, ids with the end id) of each row of batches of (doc_id, text), some of them at once."""
        some: list[pa.RecordBatch] = []
        size = 0
        for whole in batches:
            step = max(1, whole.num_rows * COLUMN_BYTES // max(1, whole.column(1).nbytes))
            for batch in [whole.slice(a, step) for a in range(0, whole.num_rows, step)]:
                some.append(batch)
                size += batch.column(1).nbytes
                if size >= COLUMN_BYTES:
                    yield from self._encode_some(some)
                    some, size = [], 0
        if some:
            yield from self._encode_some(some)

    def _encode_some(self, batches: list[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
        texts = pa.concat_arrays([batch.column(1).cast(pa.large_string()) for batch in batches])
        doc_ids = [doc_id for batch in batches for doc_id in batch.column(0).to_pylist()]
        return zip(doc_ids, self.encode_column(texts))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def as_u32(raw: bytes, width: int) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()
