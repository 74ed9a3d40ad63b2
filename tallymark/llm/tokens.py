"""Token ids of whole texts as the tokenizers library gives them, with a memory for pieces already met.

Most of the library's time goes into cutting text. Here a batch of texts is cut with array operations where the library's
pre-tokenizer always cuts: around white space and between letters, digits and ASCII marks. Each distinct piece is encoded
by the library once and remembered by its hash. Stretches with anything else (apostrophes, other scripts) are one piece
for the whole library; texts with special strings or white space beyond ASCII are encoded whole.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallymark.llm.common import Texts, ascii_lower, mixed, segment_hash

#: Pieces that a memory holds (about 30 bytes each) before it keeps only those of the last slice.
MEMORY = 3_000_000

#: The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: b for b in _SELF} | {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in set(_SELF))}

LETTER, DIGIT, MARK, SPACES, STRETCH = 1, 2, 3, 4, 5
_CLASS = np.full(128, STRETCH, np.uint8)
_CLASS[33:127] = MARK
_CLASS[48:58] = DIGIT
_CLASS[65:91] = _CLASS[97:123] = LETTER
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACES
_CLASS[39] = STRETCH


def byte_letters(piece: bytes) -> str:
    return piece.decode("latin-1").translate(_ALPHABET)


def version_digest(path: str) -> str:
    """Names a tokenizer by its file and the library's version."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()


def classes(data: np.ndarray) -> np.ndarray:
    """Class of each byte. Of what is beyond ASCII only Latin letters that keep their length in lower case are LETTER."""
    kind = np.full(len(data), STRETCH, np.uint8)
    plain = data < 128
    kind[plain] = _CLASS[data[plain]]
    if not plain.all():
        follow = np.append(data[1:], 0)
        lead = ((data == 0xC3) & (follow >= 0x80) & (follow != 0x97) & (follow != 0xB7)) | ((data == 0xC4) & (follow >= 0x80) & (follow != 0xB0))
        lead |= (data == 0xC5) & (follow >= 0x80) & (follow != 0x89) & (follow != 0xBF)
        at = np.flatnonzero(lead)
        kind[at] = kind[at + 1] = LETTER
    return kind


class Memory:
    """Ids of pieces by hash, in sorted arrays."""

    def __init__(self, most: int):
        self.most = most
        self.keys, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def ensure(self, keys: np.ndarray, make) -> np.ndarray:
        """Places of the sorted ``keys``; ``make(rows)`` gives the ids of those not yet here."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~known)
        if not len(new):
            return at
        ids = make(new)
        sizes = np.array([len(x) for x in ids], np.int64)
        flat = array("I")
        for x in ids:
            flat.extend(x)
        if len(self.keys) + len(new) > self.most:
            old = at[known]
            take = spread(self.begin[old], self.size[old])
            self.pool, self.keys, self.size = self.pool[take], self.keys[old], self.size[old]
            self.begin = np.cumsum(self.size) - self.size
        begin = len(self.pool) + np.cumsum(sizes) - sizes
        self.pool = np.concatenate((self.pool, np.frombuffer(flat, np.uint32) if len(flat) else np.zeros(0, np.uint32)))
        merged = np.concatenate((self.keys, keys[new]))
        order = np.argsort(merged, kind="stable")
        self.keys, self.begin, self.size = merged[order], np.concatenate((self.begin, begin))[order], np.concatenate((self.size, sizes))[order]
        return np.searchsorted(self.keys, keys)


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, .. (size[0] of them), then the same for begin[1] and so on."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Ids of whole texts. ``keeps_space``: a byte-level tokenizer that joins a space to what follows (byte_bpe_50k.json);
    else one that drops white space, lower-cases and takes digits one by one (word_bpe_49k.json)."""

    def __init__(self, path: str, keeps_space: bool, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model, self.keeps_space, self.memory = self.library.model, keeps_space, Memory(memory)

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: bytes, kind: int, spaced: bool) -> list[int]:
        if kind == STRETCH:
            return self.whole(" " * spaced + piece.decode("utf-8"))
        if not self.keeps_space:
            piece = piece.lower() if piece.isascii() else piece.decode("utf-8").lower().encode("utf-8")
        letters = piece.decode("latin-1") if piece.isalnum() else byte_letters(piece)
        return [t.id for t in self.model.tokenize("\u0120" + letters if spaced else letters)]

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin (one more than texts)."""
        data, n = texts.data, texts.n
        kind = classes(data)
        space = kind == SPACES
        heads = texts.offsets[:-1][texts.offsets[:-1] < len(data)]
        first = np.zeros(len(data) + 1, bool)
        first[heads] = True
        first[len(data)] = True
        odd = kind == STRETCH
        odd[:-1] |= (data[:-1] == 60) & (data[1:] == 124)
        whole = np.zeros(n, bool)
        if odd.any():  # a stretch takes in everything up to white space on both sides
            chunk_start = ~space & (first[:-1] | np.concatenate(([True], space[:-1])))
            chunk = np.cumsum(chunk_start)
            marked = np.zeros(chunk[-1] + 1, bool)
            marked[chunk[odd & ~space]] = True
            kind[marked[chunk] & ~space] = STRETCH
            for d in np.unique(np.searchsorted(texts.offsets, np.flatnonzero(odd), side="right") - 1):
                text = data[texts.offsets[d] : texts.offsets[d + 1]].tobytes().decode("utf-8")
                if "<|" in text or any(c.isspace() and c > "~" for c in text):
                    whole[d] = True
                    kind[texts.offsets[d] : texts.offsets[d + 1]] = 0
        cut = first[:-1].copy()
        cut[1:] |= kind[1:] != kind[:-1]
        if self.keeps_space:
            last = space & (kind > 0) & (first[1:] | np.append(~space[1:], True))  # the last of a run of white space
            last &= ~first[1:]  # what ends the text stays together
            cut[last] = True  # stands alone, or belongs to what follows
            joined = last & (data == 32)
            kind = kind.copy()
            kind[joined] = 0
        else:
            kind = np.where(space, np.uint8(0), kind)
            cut |= kind == DIGIT
            joined = np.zeros(len(data), bool)
        starts = np.flatnonzero(cut & (kind > 0))
        if not len(starts):
            ids, sizes = np.zeros(0, np.uint32), np.zeros(n, np.int64)
        else:
            h = segment_hash(data if self.keeps_space else ascii_lower(data), starts, kind > 0)
            spaced = joined[np.maximum(starts - 1, 0)] & (starts > 0) & ~first[starts]
            h ^= mixed((kind[starts] == STRETCH).astype(np.uint64) + np.uint64(2) * spaced.astype(np.uint64) + np.uint64(9))
            keys, where, inverse = np.unique(h, return_index=True, return_inverse=True)
            ends = np.flatnonzero((cut | (kind == 0)))  # a piece ends where another begins or at a byte outside
            ends = np.append(ends, len(data))

            at = starts[where]
            stop, own_kind, own_space, raw = ends[np.searchsorted(ends, at, side="right")], kind[at], spaced[where], data.tobytes()

            def make(new):
                rows = zip(at[new].tolist(), stop[new].tolist(), own_kind[new].tolist(), own_space[new].tolist())
                return [self._piece(raw[s:e], k, joins) for s, e, k, joins in rows]

            place = self.memory.ensure(keys, make)[inverse]
            size = self.memory.size[place]
            ids = self.memory.pool[spread(self.memory.begin[place], size)]
            doc = np.searchsorted(texts.offsets, starts, side="right") - 1
            sizes = np.bincount(doc, weights=size, minlength=n).astype(np.int64)
        if whole.any():
            parts, bounds = [], np.concatenate(([0], np.cumsum(sizes)))
            for d in range(n):
                if whole[d]:
                    part = np.array(self.whole(data[texts.offsets[d] : texts.offsets[d + 1]].tobytes().decode("utf-8")), np.uint32)
                    sizes[d] = len(part)
                    parts.append(part)
                else:
                    parts.append(ids[bounds[d] : bounds[d + 1]])
            ids = np.concatenate(parts)
        return ids, np.concatenate(([0], np.cumsum(sizes)))

    def batches(self, column: pa.Array) -> Iterator[tuple[Texts, np.ndarray, np.ndarray]]:
        for texts in Texts.slices(column):
            yield texts, *self.encode(texts)


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, keeps_space: bool) -> Encoder:
    """One encoder for each tokenizer and worker process, so that its memory serves later tasks too."""
    key = (path, keeps_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, keeps_space)
    return _ENCODERS[key]
