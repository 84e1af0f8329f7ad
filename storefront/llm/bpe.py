"""Byte-level BPE ids of whole slices of documents.

The texts are cut into the pieces of the tokenizer's split pattern with numpy;
every distinct piece is encoded once by the tokenizer itself and its ids are kept
under a 64-bit hash of its bytes.  A task sees far fewer distinct pieces than
pieces.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np

from . import textvec as tv

class SliceEncoder:
    """ids of concatenated texts; special tokens in a text are ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self._empty()

    def _empty(self) -> None:
        self.known = tv.KeyTable()
        self.at = np.zeros(len(self.known.keys), np.uint32)
        self.size = np.zeros(len(self.known.keys), np.uint32)
        self.ids = np.zeros(1 << 20, np.uint32)
        self.n_ids = 0

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and each text's number of ids."""
        n_docs = len(offsets) - 1
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(n_docs, np.int64)
        cps, cp_offsets = tv.code_points(data, offsets)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        starts = lead[tv.piece_starts(cps, cp_offsets)]
        ends = np.append(starts[1:], len(data))
        h = tv.span_hashes(tv.BYTE_HASH[data], starts) ^ tv.mix64((ends - starts).astype(np.uint64))
        h[h == 0] = 1
        place = self.known.find(h)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            keys, first = np.unique(h[missing], return_index=True)
            if not self.known.room(len(keys)):
                self._empty()
                if not self.known.room(len(h)):  # one very long text: the table would not hold its pieces
                    return self._plain(data, offsets)
                keys, missing = np.unique(h, return_index=True)
                first = np.arange(len(keys))
            raw = data.tobytes()
            self._learn(keys, [raw[starts[i]:ends[i]].decode("utf-8") for i in missing[first]])
            place = self.known.find(h)
        size = self.size[place].astype(np.int64)
        total = np.cumsum(size)
        index = np.repeat(self.at[place] - (total - size), size) + np.arange(total[-1])
        bounds = np.concatenate(([0], total))[np.searchsorted(starts, offsets)]
        return self.ids[index], np.diff(bounds)

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[a:b].tobytes().decode("utf-8") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter(chain.from_iterable(encoded), np.uint32, int(size.sum())), size

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, encoded), np.int64, len(encoded))
        more = np.fromiter(chain.from_iterable(encoded), np.uint32, int(size.sum()))
        while self.n_ids + len(more) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.n_ids:self.n_ids + len(more)] = more
        at = self.n_ids + np.cumsum(size) - size
        self.n_ids += len(more)
        place = self.known.add(keys)
        self.at[place], self.size[place] = at, size


@lru_cache(maxsize=2)
def slice_encoder(path: str) -> SliceEncoder:
    """One encoder for each Python worker and vocabulary file."""
    return SliceEncoder(path)
