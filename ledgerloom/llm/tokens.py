"""Token ids of whole batches of texts.

The vocabulary drops white space and never joins a letter or digit to a punctuation mark, so a text's ids are the ids of its
chunks in order, where chunks are cut at ASCII white space and between ASCII letters or digits and ASCII marks other than the
apostrophe. A string that is an added token of the vocabulary (``<|endoftext|>``) is one chunk wherever it stands. Texts repeat their chunks, so each distinct chunk of a slice is encoded once, and a task process remembers
up to ``REMEMBERED`` of them. ``tests/llm/test_tokens.py`` compares with encoding whole texts.
"""

from __future__ import annotations

import re
import sys
import types

import numpy as np
import pandas as pd

from ledgerloom.llm.arrays import U64, Sums, runs

REMEMBERED = 1_000_000
TOGETHER = 500

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: 1: ASCII letter or digit, 2: ASCII mark other than the apostrophe, 0: anything else
_SIDE = np.zeros(256, dtype=np.uint8)
_SIDE[0x21:0x7F] = 2
_SIDE[0x30:0x3A] = _SIDE[0x41:0x5B] = _SIDE[0x61:0x7B] = 1
_SIDE[0x27] = 0


class ChunkIds:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = sorted(t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.added = re.compile(b"|".join(map(re.escape, added[::-1]))) if added else None
        self._forget()

    def _forget(self) -> None:
        #: hashes of the chunks known, ascending; where the ids of each begin, and their number
        self.known = np.zeros(0, dtype=U64)
        self.start = self.length = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def _learn(self, hashes: np.ndarray, texts: list[bytes]) -> None:
        """Encodes new chunks, many to a text; the place of a token in the text tells its chunk."""
        chunks = [t.decode("utf-8", "replace") for t in texts]
        groups = [chunks[at : at + TOGETHER] for at in range(0, len(chunks), TOGETHER)]
        starts, lengths = [self.start], [self.length]
        for at, group in enumerate(groups):
            if at % 20 == 0:  # some at a time: encodings are large
                some = self.tokenizer.encode_batch([" ".join(g) for g in groups[at : at + 20]], add_special_tokens=False)
            encoded = some[at % 20]
            begins = np.cumsum([0, *[len(c) + 1 for c in group]])
            place = np.array([a for a, _ in encoded.offsets], dtype=np.int64)
            split = np.searchsorted(place, begins)
            if self.used + len(place) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(self.used + len(place), dtype=np.uint32)])
            self.ids[self.used : self.used + len(place)] = encoded.ids
            starts.append(split[:-1] + self.used)
            lengths.append(np.diff(split))
            self.used += len(place)
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known, self.start, self.length = known[order], np.concatenate(starts)[order], np.concatenate(lengths)[order]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a slice, end to end, and where each row's begin."""
        if len(self.known) > REMEMBERED:
            self._forget()
        side = _SIDE[data]
        cut = np.flatnonzero(side[1:] * side[:-1] == 2) + 1
        raw = data.tobytes()
        spans = np.array([m.span() for m in self.added.finditer(raw)] if self.added else [], dtype=np.int64).reshape(-1, 2)
        if len(spans):
            # Not what only two rows together spell; and no cuts inside.
            row = np.searchsorted(offsets, spans[:, 0], side="right")
            spans = spans[spans[:, 1] <= offsets[row]]
            inside = np.zeros(len(data) + 1, dtype=np.int64)
            np.add.at(inside, spans[:, 0] + 1, 1)
            np.add.at(inside, spans[:, 1], -1)
            cut = cut[np.cumsum(inside)[cut] == 0]
        start, end = runs(~_SPACE[data], np.concatenate([offsets, cut, spans.ravel()]))
        code, distinct = pd.factorize(Sums(data).of(start, end))
        at = np.searchsorted(self.known, distinct)
        fresh = np.ones(len(distinct), dtype=bool)
        inside = at < len(self.known)
        fresh[inside] = self.known[at[inside]] != distinct[inside]
        if fresh.any():
            first = np.zeros(len(distinct), dtype=np.int64)
            first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            new = np.flatnonzero(fresh)
            self._learn(distinct[new], [raw[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            at = np.searchsorted(self.known, distinct)
        lengths = self.length[at][code]
        placed = np.zeros(len(code) + 1, dtype=np.int64)
        np.cumsum(lengths, out=placed[1:])
        take = np.repeat(self.start[at][code] - placed[:-1], lengths)
        take += np.arange(placed[-1])
        return self.ids[take], placed[np.searchsorted(start, offsets)]


def chunk_ids(path: str) -> ChunkIds:
    """The encoder of this process: it stays for the tasks to come."""
    kept = sys.modules.setdefault("_chunk_ids_of_this_process", types.ModuleType("_chunk_ids_of_this_process"))
    if path not in vars(kept):
        setattr(kept, path, ChunkIds(path))
    return getattr(kept, path)
