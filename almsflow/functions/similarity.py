"""Token-sort similarity: 200 * LCS / (len1 + len2) on sorted-word strings.

The longest common subsequence has no built-in expression, so it runs as an
Arrow-batched function that scores a whole batch of pairs at once: one bit per
position of the first string, a few vector operations per position of the second
(Hyyro's bit-parallel recurrence, 2004).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from almsflow.functions.text import sorted_tokens

_CELLS = 4_000_000  # mask cells held at once
_TOGETHER = 8_192  # pairs scored at once, so that their state stays in the cache


class Lcs:
    """Longest common subsequences of pairs of rows of two lists of strings.

    Where each character occurs in a left string is worked out once for all its pairs.
    """

    def __init__(self, left: list[str], right: list[str]):
        (a, self.a_lengths, self.a_starts), (b, self.b_lengths, self.b_starts) = self._flat(left), self._flat(right)
        known, self.a = np.unique(a, return_inverse=True)
        near = np.searchsorted(known, b)
        self.width = len(known) + 1
        # A character that no left string has gets the last column, which stays empty.
        self.b = np.where(np.append(known, -1)[near] == b, near, len(known))
        self.words = (self.a_lengths + 63) // 64

    @staticmethod
    def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(t) for t in texts], np.int64)
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        return codes, lengths, np.cumsum(lengths) - lengths

    def lengths(self, l: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Of the pairs (l[0], r[0]), (l[1], r[1]), ..."""
        out = np.zeros(len(l), np.int64)
        rows = np.unique(l)
        for words in np.unique(self.words[rows]).tolist():
            own = rows[self.words[rows] == words] if words else rows[:0]  # an empty string shares nothing
            step = max(1, _CELLS // (words * self.width or 1))
            for part in (own[at:at + step] for at in range(0, len(own), step)):
                number = np.full(len(self.words), -1)
                number[part] = np.arange(len(part))
                pairs = np.flatnonzero(number[l] >= 0)
                pairs = pairs[np.argsort(-self.b_lengths[r[pairs]], kind="stable")]
                masks = self._masks(part, words)
                for at in range(0, len(pairs), _TOGETHER):
                    some = pairs[at:at + _TOGETHER]
                    out[some] = self._score(masks, number[l[some]], r[some])
        return out

    def _masks(self, rows: np.ndarray, words: int) -> np.ndarray:
        """Per word, row and character (flat) a bit for every place of the character in the row."""
        sizes = self.a_lengths[rows]
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        cell = (place // 64 * len(rows) + np.repeat(np.arange(len(rows)), sizes)) * self.width + self.a[np.repeat(self.a_starts[rows], sizes) + place]
        masks = np.zeros(words * len(rows) * self.width, np.uint64)
        np.add.at(masks, cell, np.uint64(1) << (place % 64).astype(np.uint64))  # all bits of a cell differ
        return masks.reshape(words, -1)

    def _score(self, masks: np.ndarray, rows: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Pairs in descending order of the right lengths, so that those not yet at their end come first."""
        first, starts, lengths = rows * self.width, self.b_starts[r], self.b_lengths[r]
        state = np.full((len(masks), len(r)), np.uint64(0xFFFFFFFFFFFFFFFF))
        open_pairs = np.searchsorted(-lengths, -np.arange(lengths.max(initial=0)), side="left")
        for place, n in enumerate(open_pairs.tolist()):
            cell = first[:n] + self.b[starts[:n] + place]
            carry = None
            for word, own in enumerate(masks):
                row = state[word, :n]
                hit = row & own[cell]
                total = row + hit
                if len(masks) > 1:
                    over = total < row
                    if carry is not None:
                        total = total + carry
                        over |= total < carry
                    carry = over.astype(np.uint64)
                state[word, :n] = total | (row ^ hit)
        # Bits behind the end of a left string occur in no mask and stay set.
        return np.bitwise_count(~state).sum(axis=0, dtype=np.int64)


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """LCS length of each pair."""
    each = np.arange(len(left))
    return Lcs(left, right).lengths(each, each)


@F.pandas_udf(T.IntegerType())
def lcs(left: pd.Series, right: pd.Series) -> pd.Series:
    """Length of the longest common subsequence of two non-null strings."""
    return pd.Series(lcs_lengths(left.tolist(), right.tolist()), dtype="int32")


# The optimizer copies a deterministic expression into every filter that uses its
# column and moves those below shuffles; this one is too costly to run twice.
lcs = lcs.asNondeterministic()


def indel_score(left: Column, right: Column) -> Column:
    """Normalised indel similarity, 0-100; two empty strings are equal."""
    both = F.length(left) + F.length(right)
    return F.when(both == 0, F.lit(100.0)).otherwise(F.lit(200.0) * lcs(left, right) / both)


def token_sort_score(left: Column, right: Column) -> Column:
    """Similarity that ignores the order of words."""
    return indel_score(sorted_tokens(left), sorted_tokens(right))


def levenshtein_score(left: Column, right: Column) -> Column:
    """A built-in alternative scorer: 100 * (1 - edit distance / longer length)."""
    longer = F.greatest(F.length(left), F.length(right))
    return F.when(longer == 0, F.lit(100.0)).otherwise(100.0 * (1 - F.levenshtein(left, right) / longer))
