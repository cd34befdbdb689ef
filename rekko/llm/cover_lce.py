"""Longest common extensions of word positions from a sparse suffix array over a difference cover.

Every residue modulo ``MODULUS`` is the difference of two members of ``COVER``, so
for any two positions a shift below the modulus brings both to sampled ones.  Only
the sampled suffixes are sorted, within their document: by a few words at a
time, then by doubling, always only what is still tied.  Common prefixes of neighbours
and a sparse table over them answer any two samples; a query
compares the few words up to the samples first.
"""

from __future__ import annotations

import numpy as np

# A perfect difference set: each residue but 0 is one difference.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)
FAR = np.int64(2 ** 62)


def first_members() -> np.ndarray:
    """For each difference t, a member d of the cover such that d + t is one too."""
    table = np.zeros(MODULUS, dtype=np.int64)
    for d in COVER:
        for e in COVER:
            table[(e - d) % MODULUS] = d
    return table


FIRST = first_members()


class SparseTable:
    """Range minima of an array by powers of two."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum over ``low`` .. ``high``, both included."""
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.rows[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k)) + 1])
        return out


class CoverLce:
    """Extensions within documents laid end to end.

    ``words`` are numbers below ``vocabulary``, with one separator of its own behind each
    document (any number at or above ``vocabulary`` that occurs once); ``doc`` is the document of each position.
    """

    def __init__(self, words: np.ndarray, doc: np.ndarray):
        self.n = len(words)
        top = int(words.max(initial=0)) + 1
        self.words = np.concatenate((words, top + np.arange(2 * MODULUS)))
        self.base = top + 2 * MODULUS
        sampled = np.zeros(MODULUS, dtype=bool)
        sampled[list(COVER)] = True
        self.order = np.flatnonzero(sampled[np.arange(self.n) % MODULUS])
        self.slot = np.zeros(self.n, dtype=np.int64)
        self.prefix = np.zeros(len(self.order), dtype=np.int64)     # common words of a slot and the one before
        self.sort(doc[self.order])
        self.slot[self.order] = np.arange(len(self.order))
        self.table = SparseTable(self.prefix)

    def sort(self, doc: np.ndarray) -> None:
        m = len(self.order)
        if not m:
            return
        head = np.ones(m, dtype=bool)
        head[1:] = doc[1:] != doc[:-1]
        group = np.maximum.accumulate(np.where(head, np.arange(m), 0))      # first slot of each slot's group
        self.slot[self.order] = group
        tied = self.tied(np.arange(m), group)
        depth = 0
        while len(tied):
            at, own = self.order[tied], group[tied]
            if depth < MODULUS:
                step = min(MODULUS - depth, 2 if m * self.base * self.base < FAR else 1)
                key = self.words[at + depth]
                if step == 2:
                    key = key * self.base + self.words[at + depth + 1]
            else:
                step, key = depth, self.slot[at + depth]
            ranks = np.lexsort((key, own)) if step > 2 or m * self.base ** step >= FAR else np.argsort(
                own * self.base ** step + key, kind="stable")
            key, moved = key[ranks], at[ranks]
            self.order[tied] = moved
            split = np.zeros(len(tied), dtype=bool)
            split[1:] = (own[1:] == own[:-1]) & (key[1:] != key[:-1])
            here = np.flatnonzero(split)
            if depth < MODULUS:
                a, b = moved[here - 1] + depth, moved[here] + depth
                shared = self.words[a] == self.words[b] if step == 2 else np.zeros(len(here), dtype=bool)
                self.prefix[tied[here]] = depth + shared
            elif len(here):
                self.prefix[tied[here]] = depth + self.between(key[here - 1], key[here], group)
            group[tied[here]] = tied[here]
            group[tied] = self.heads(tied, own, split)
            self.slot[moved] = group[tied]
            tied = self.tied(tied, group[tied])
            depth += step

    @staticmethod
    def heads(tied: np.ndarray, own: np.ndarray, split: np.ndarray) -> np.ndarray:
        start = split.copy()
        start[0] = True
        start[1:] |= own[1:] != own[:-1]
        return tied[np.maximum.accumulate(np.where(start, np.arange(len(tied)), 0))]

    @staticmethod
    def tied(slots: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Slots whose group has another member."""
        same = group[1:] == group[:-1]
        keep = np.zeros(len(slots), dtype=bool)
        keep[1:] |= same
        keep[:-1] |= same
        return slots[keep]

    def between(self, a: np.ndarray, b: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Common words of samples in the groups that begin at slots ``a`` and ``b``, which are split already."""
        known = np.where(group == np.arange(len(group)), self.prefix, FAR)
        return SparseTable(known).least(np.minimum(a, b) + 1, np.maximum(a, b))

    def extend(self, i: np.ndarray, j: np.ndarray, chunk: int = 20_000) -> np.ndarray:
        """Words that positions ``i`` and ``j`` (of one document, not equal) have in common."""
        out = np.empty(len(i), dtype=np.int64)
        for at in range(0, len(i), chunk):
            out[at:at + chunk] = self._extend(i[at:at + chunk], j[at:at + chunk])
        return out

    def _extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        shift = (FIRST[(j - i) % MODULUS] - i) % MODULUS
        ahead = np.arange(MODULUS)
        last = len(self.words) - 1
        differ = (self.words[np.minimum(i[:, None] + ahead, last)] != self.words[np.minimum(j[:, None] + ahead, last)])
        differ[:, -1] = True
        out = np.minimum(differ.argmax(axis=1), shift)
        far = np.flatnonzero(out == shift)
        if len(far):
            a, b = self.slot[i[far] + shift[far]], self.slot[j[far] + shift[far]]
            out[far] += self.table.least(np.minimum(a, b) + 1, np.maximum(a, b))
        return out
