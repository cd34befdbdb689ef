"""Deep-shallow sorting of byte strings.

Strings are first ordered by multikey quicksort to a shallow depth: eight bytes
at a time, each step sorting only the members of a group that all earlier bytes
left tied.  Groups that are tied at that depth and still differ behind it have
long common prefixes; a blind trie orders each, comparing a string in full with
one leaf only.
"""

from __future__ import annotations

import numpy as np


def words_of(strings: np.ndarray) -> np.ndarray:
    """Rows of zero-padded bytes (a multiple of 8) as big-endian 64-bit characters."""
    return np.ascontiguousarray(strings).view(">u8").astype(np.uint64)


class BlindTrie:
    """Branch nodes hold the depth at which their strings part and a child for each byte there."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.numbers = [int.from_bytes(s, "big") for s in strings]
        self.root: list | int | None = None
        self.same: dict[int, list[int]] = {}        # leaf -> the strings equal to it
        for i in range(len(strings)):
            self._insert(i)

    def _common(self, i: int, j: int) -> int:
        """Length of the common prefix; all strings have the same length."""
        return len(self.strings[i]) - (((self.numbers[i] ^ self.numbers[j]).bit_length() + 7) >> 3)

    def _insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root, self.same[i] = i, [i]
            return
        node = self.root
        while not isinstance(node, int):            # blind: only branching bytes are looked at
            node = node[1].get(s[node[0]]) if s[node[0]] in node[1] else next(iter(node[1].values()))
        depth = self._common(i, node)
        if depth == len(s):
            self.same[node].append(i)
            return
        self.same[i] = [i]
        other, parent, node = self.strings[node], None, self.root
        while not isinstance(node, int) and node[0] < depth:
            parent, node = node, node[1][s[node[0]]]
        if not isinstance(node, int) and node[0] == depth:
            node[1][s[depth]] = i
            return
        branch = [depth, {other[depth]: node, s[depth]: i}]
        if parent is None:
            self.root = branch
        else:
            parent[1][s[parent[0]]] = branch

    def order(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, int):
                out += self.same[node]
            elif node is not None:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
        return out


def deep_shallow(strings: np.ndarray, groups: np.ndarray, shallow: int,
                 lengths: np.ndarray | None = None) -> np.ndarray:
    """Order of the rows by (group, string).

    ``strings`` has rows of equal, zero-padded length (a multiple of 8), of
    which the first ``shallow`` bytes (a multiple of 8) are sorted by multikey
    quicksort.  Of rows that are equal with their padding the one with the
    smaller of ``lengths`` comes first, as zeros may belong to a string.
    """
    words = words_of(strings)
    # every later step is stable, so equal rows stay in this order
    order = np.argsort(groups, kind="stable") if lengths is None else np.lexsort((lengths, groups))
    tied = groups[order]                            # equal numbers: still tied
    for step in range(shallow // 8):
        first = np.concatenate(([True], tied[1:] != tied[:-1]))
        sizes = np.diff(np.append(np.nonzero(first)[0], len(tied)))
        open_ = np.repeat(sizes > 1, sizes)
        where = np.nonzero(open_)[0]
        if not len(where):
            break
        members, key = order[where], words[order[where], step]
        inner = np.lexsort((key, tied[where]))
        order[where], key = members[inner], key[inner]
        new = np.zeros(len(tied), dtype=bool)
        new[first] = True
        new[where[1:]] |= (key[1:] != key[:-1])
        tied = np.cumsum(new)
    first = np.nonzero(np.concatenate(([True], tied[1:] != tied[:-1])))[0] if len(tied) else np.zeros(0, int)
    sizes = np.diff(np.append(first, len(tied)))
    rest = words[order, shallow // 8:]
    differs = np.concatenate(([False], (rest[1:] != rest[:-1]).any(axis=1) & (tied[1:] == tied[:-1]))) \
        if len(tied) else np.zeros(0, bool)
    uneven = np.add.reduceat(differs, first) > 0 if len(first) else first
    width = strings.shape[1]
    for at, size in zip(first[uneven].tolist(), sizes[uneven].tolist(), strict=True):
        members = order[at:at + size]
        data = strings[members, shallow:].tobytes()
        step = width - shallow
        trie = BlindTrie([data[i * step:(i + 1) * step] for i in range(size)])
        order[at:at + size] = members[trie.order()]
    return order


def common_prefixes(strings: np.ndarray, lengths: np.ndarray, groups: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before it in ``order`` (-1 at a group's start)."""
    words = words_of(strings)[order]
    out = np.full(len(order), -1, dtype=np.int64)
    if len(order) < 2:
        return out
    differ = words[1:] ^ words[:-1]
    word = np.argmax(differ != 0, axis=1)
    value = differ[np.arange(len(differ)), word]
    # leading zero bytes of the first differing word
    lead = np.zeros(len(value), dtype=np.int64)
    for byte in range(8):
        lead += (value >> np.uint64(8 * (7 - byte))) == 0
    common = np.where(value == 0, strings.shape[1], 8 * word + lead)
    size, group = lengths[order], groups[order]
    out[1:] = np.where(group[1:] == group[:-1], np.minimum(common, np.minimum(size[1:], size[:-1])), -1)
    return out
