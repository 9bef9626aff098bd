"""String similarity for record linkage.

Both run as Arrow-batched functions, and the linkage operators call them only on candidate pairs of
distinct texts that already agree on date or amount.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; stays in the JVM."""
    x, y = F.lower(a), F.lower(b)
    longest = F.greatest(F.length(x), F.length(y))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(x, y) / longest)


class EditDistances:
    """Edit similarity of one text after another to a set of texts, all of them at once.

    Every text is cut in two, and distinct heads and tails are compared once, with all beginnings and all ends of the other text.
    The distance is the least sum over the places where the other text can be cut. Texts without recurring parts cost what whole ones do.
    """

    #: Shares of a text at which it may be cut; the one that leaves fewest distinct parts is taken.
    CUTS = (0.5, 0.25, 0.75)

    def __init__(self, texts: list[str]):
        self.length = np.array([len(t) for t in texts], dtype=np.int64)

        def parts(cuts: list[int]) -> int:
            return len({t[:c] for t, c in zip(texts, cuts)}) + len({t[c:] for t, c in zip(texts, cuts)})

        cuts = min(((share * self.length).astype(np.int64).tolist() for share in self.CUTS), key=parts)
        self.heads, self.tails = _Columns([t[:c] for t, c in zip(texts, cuts)]), _Columns([t[c:][::-1] for t, c in zip(texts, cuts)])

    def similarities(self, text: str) -> np.ndarray:
        """1 - edit distance / longer length, in the order of the texts given."""
        longest = np.maximum(self.length, len(text))
        return np.where(longest == 0, 1.0, 1 - self.distances(text) / np.maximum(longest, 1))

    def distances(self, text: str) -> np.ndarray:
        if not len(self.length):
            return np.empty(0, dtype=np.uint8)
        # Several small numbers in one word: no sum of two of them is too large for its place.
        limit = max(len(text), self.heads.most, self.tails.most)
        kind = next(k for k in (np.uint8, np.uint16, np.uint32) if 2 * limit <= np.iinfo(k).max)
        places = 8 // np.dtype(kind).itemsize
        width = -(-(len(text) + 1) // places) * places
        first = self.heads.table(text, width, limit, kind)
        # The other way round, the end of the text that a tail is compared with stands where the beginning left of it does.
        last = self.tails.table(text[::-1], width, limit, kind)
        last[:, : len(text) + 1] = last[:, len(text)::-1].copy()
        first, last = (x.view(np.uint64).T.copy() for x in (first, last))
        least = None
        for x, y in zip(first, last):
            sums = (x[self.heads.of] + y[self.tails.of]).view(kind)
            least = sums if least is None else np.minimum(least, sums, out=least)
        half = places // 2
        while half:
            np.minimum(least, (least.view(np.uint64) >> np.uint64(64 * half // places)).view(kind), out=least)
            half //= 2
        return least[::places].copy()


#: For every byte, how many of its lowest 1 to 8 bits are set: eight small numbers in one word.
_SET_BITS = np.array([[(b & ((2 << t) - 1)).bit_count() for t in range(8)] for b in range(256)], dtype=np.uint8).view(np.uint64).ravel()


class _Columns:
    """Last columns of the distance tables of one text and many others, whose distinct beginnings are looked at once.

    Texts of at most 64 letters move a whole column as bits of one number; longer ones move cell by cell.
    """

    def __init__(self, texts: list[str]):
        length = np.array([len(t) for t in texts], dtype=np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        seen = np.zeros(int(points.max(initial=0)) + 1, dtype=bool)
        seen[points] = True
        self.letters, codes = np.flatnonzero(seen), (np.cumsum(seen) - 1)[points]
        start, size = np.cumsum(length) - length, len(self.letters) + 1
        self.most = int(length.max(initial=0))
        self.of = np.zeros(len(texts), dtype=np.int64)  # the row of every text given
        lengths, rows = [], 0
        # Beginnings of j letters: where each one's own beginning is among those before, its last letter, and those that are whole texts.
        self.levels: list[tuple[np.ndarray | None, np.ndarray | None, np.ndarray]] = []
        going, node, parent, letter = np.arange(len(texts)), np.zeros(len(texts), dtype=np.int64), None, None
        for j in range(self.most + 1):
            ended = length[going] == j
            whole, row = np.unique(node[ended], return_inverse=True)
            self.of[going[ended]] = rows + row
            rows += len(whole)
            lengths.append(np.full(len(whole), j, dtype=np.int64))
            self.levels.append((parent, letter, whole))
            going, node = going[~ended], node[~ended]
            if len(going):
                both, node = np.unique(node * size + codes[start[going] + j], return_inverse=True)
                parent, letter = both // size, both % size
        self.length = np.concatenate(lengths)

    def table(self, text: str, width: int, rest: int, kind: type) -> np.ndarray:
        """Distances of every distinct text (rows) to every beginning of ``text``, the empty one first; further columns hold ``rest``."""
        out = np.full((len(self.length), width), rest, dtype=kind)
        self._by_bits(text, out) if len(text) <= 64 else self._by_cells(text, out)
        return out

    def _by_bits(self, text: str, out: np.ndarray) -> None:
        masks, one = np.zeros(len(self.letters) + 1, dtype=np.uint64), np.uint64(1)
        for i, point in enumerate(map(ord, text)):
            k = int(np.searchsorted(self.letters, point))
            if k < len(self.letters) and self.letters[k] == point:
                masks[k] |= np.uint64(1 << i)
        up, down = np.full(1, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64), np.zeros(1, dtype=np.uint64)
        ups, downs = [], []
        for parent, letter, whole in self.levels:
            if parent is not None:
                p, m, hit = up[parent], down[parent], masks[letter]
                across = (((hit & p) + p) ^ p) | hit
                right = m | ~(across | p)
                left = p & across
                right = (right << one) | one
                hit |= m
                up = (left << one) | ~(hit | right)
                down = right & hit
            ups.append(up[whole])
            downs.append(down[whole])
        # Bits say whether a cell is one more or one less than the cell before it.
        more, less = (np.concatenate(x).view(np.uint8).reshape(-1, 8) for x in (ups, downs))
        out[:, 0] = self.length
        if out.dtype == np.uint8:
            at, every = self.length.astype(np.uint64), np.uint64(0x0101010101010101)
            for k in range(0, len(text), 8):
                word = at * every + _SET_BITS[more[:, k // 8]] - _SET_BITS[less[:, k // 8]]
                some = min(8, len(text) - k)
                out[:, k + 1: k + 1 + some] = word.view(np.uint8).reshape(-1, 8)[:, :some]
                at = word >> np.uint64(56)
        else:
            steps = [np.unpackbits(x, axis=1, bitorder="little").view(np.int8)[:, : len(text)] for x in (more, less)]
            out[:, 1: len(text) + 1] = self.length[:, None] + np.cumsum(steps[0] - steps[1], axis=1, dtype=np.int64)

    def _by_cells(self, text: str, out: np.ndarray) -> None:
        known = [int(k) if k < len(self.letters) and self.letters[k] == point else -1
                 for point in map(ord, text) for k in (np.searchsorted(self.letters, point),)]
        column, rows = np.arange(len(text) + 1)[:, None], 0
        for j, (parent, letter, whole) in enumerate(self.levels):
            if parent is not None:
                before = column[:, parent]
                column = np.empty_like(before)
                column[0] = j
                for i, code in enumerate(known):
                    column[i + 1] = np.minimum(np.minimum(column[i], before[i + 1]) + 1, before[i] + (letter != code))
            out[rows: rows + len(whole), : len(text) + 1] = column[:, whole].T
            rows += len(whole)


#: Letters are counted in so many classes.
LETTERS = 32


def letter_counts(text: Column) -> Column:
    """Occurrences of letters by class: an array of ``LETTERS`` small numbers."""
    classes = F.transform(F.split(text, ""), lambda c: F.pmod(F.ascii(c), F.lit(LETTERS)))
    empty = F.array_repeat(F.lit(0), LETTERS)
    return F.when(F.length(text) == 0, empty).otherwise(
        F.transform(F.sequence(F.lit(0), F.lit(LETTERS - 1)), lambda k: F.size(F.filter(classes, lambda c: c == k))))


def common_letters(x: Column, y: Column) -> Column:
    """At least as many letters as any alignment of two texts can match, from their letter counts."""
    return F.aggregate(F.zip_with(x, y, lambda m, n: F.least(m, n)), F.lit(0), lambda acc, n: acc + n)


def blocks_bound(n: Column, x: Column, m: Column, y: Column) -> Column:
    """No matching-blocks ratio of texts with these lengths and letter counts is higher."""
    return F.when(n + m == 0, F.lit(1.0)).otherwise(2.0 * common_letters(x, y) / (n + m))


def edit_bound(n: Column, x: Column, m: Column, y: Column) -> Column:
    """No edit similarity of texts with these lengths and letter counts is higher."""
    longest = F.greatest(n, m)
    return F.when(longest == 0, F.lit(1.0)).otherwise(common_letters(x, y) / longest)


@F.pandas_udf(DoubleType())
def matching_blocks_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of characters in matching blocks, ignoring case (0 to 1).

    Pairs are taken by their second text, whose index of positions is built once for all its partners in a batch.
    """
    first, second = a.str.lower().to_numpy(), b.str.lower().to_numpy()
    out, matcher, now = np.zeros(len(first)), SequenceMatcher(None), None
    for k in np.argsort(second, kind="stable"):
        if now is None or second[k] != now:
            now = second[k]
            matcher.set_seq2(now)
        matcher.set_seq1(first[k])
        out[k] = matcher.ratio()
    return pd.Series(out)


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word per step."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def token_set_score(a: str, b: str) -> float:
    """Token-set similarity (0 to 1): compare the shared words with shared-plus-own words of each side."""
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    shared, only_left, only_right = left & right, left - right, right - left
    if shared and (not only_left or not only_right):
        return 1.0
    base = " ".join(sorted(shared))
    own_left, own_right = " ".join(sorted(only_left)), " ".join(sorted(only_right))
    full_left = f"{base} {own_left}" if base else own_left
    full_right = f"{base} {own_right}" if base else own_right
    # The common front is equal on both sides, so only the tails differ.
    tails = len(own_left) + len(own_right) - 2 * _common_subsequence(own_left, own_right)
    best = 1.0 - tails / (len(full_left) + len(full_right))
    if base:
        best = max(
            best,
            2.0 * len(base) / (len(base) + len(full_left)),
            2.0 * len(base) / (len(base) + len(full_right)),
        )
    return best


def token_set_quick(a: Column, b: Column, threshold: float) -> Column:
    """The token-set score where the sets of words decide it, 0 where it cannot reach the threshold, else null."""
    left, right = (F.array_distinct(F.filter(F.split(x, r"(?U)\s+"), lambda w: w != "")) for x in (a, b))
    shared = F.size(F.array_intersect(left, right))
    # The words as one text each: no alignment matches more than their common letters, and shared words alone give the rest.
    (n, x), (m, y) = ((F.length(t), letter_counts(t)) for t in (F.array_join(left, " "), F.array_join(right, " ")))
    base = F.length(F.array_join(F.array_intersect(left, right), " "))
    alone = F.when(base == 0, 0.0).otherwise(2.0 * base / (base + F.least(n, m)))
    return (
        F.when((F.size(left) == 0) | (F.size(right) == 0), 0.0)
        .when((shared > 0) & ((shared == F.size(left)) | (shared == F.size(right))), 1.0)
        .when((2.0 * F.least(n, m) < F.lit(threshold) * (n + m)) & (alone < threshold), 0.0)
        .when((blocks_bound(n, x, m, y) < threshold) & (alone < threshold), 0.0)
    )


@F.pandas_udf(DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_score(x, y) for x, y in zip(a, b)], dtype="float64")
