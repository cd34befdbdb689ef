"""Brute-force restatements of the corpus operators for small fixtures."""

from __future__ import annotations

import hashlib
import re

import xxhash


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def fingerprint(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps: list[int], ids: list, max_bits: int = 3) -> list:
    """Smallest id reachable over links of at most ``max_bits`` differing bits."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least: dict = {}
    for i, x in enumerate(ids):
        if x is not None:
            r = find(i)
            least[r] = min(least.get(r, x), x)
    return [least.get(find(i)) for i in range(len(fps))]


def cut(rows: list[tuple[int | None, str | None]], length: int = 50) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) for each (id, text)."""
    rows = [(2 ** 63 - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    least: dict[bytes, int] = {}
    for i, b in rows:
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            least[s] = min(least.get(s, i), i)
    out = []
    for i, b in rows:
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if least[b[p:p + length]] < i:
                gone[p:p + length] = [True] * length
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone, strict=True) if not g))))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(digits[::-1]):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def span_dedup(rows: list[tuple[int, str]], span: int = 2, min_words: int = 12) -> dict[int, tuple[int, int, str]]:
    """(n_sentences, n_removed, kept) by id, for rows with distinct ids."""
    pieces = {i: re.findall(r"[^.!?\n]*[.!?\n][.!?\n \t]*|[^.!?\n]+", t) for i, t in rows}
    full = {i: [j for j, x in enumerate(p) if x.strip(" \t\n")] for i, p in pieces.items()}
    seen, gone = set(), {i: set() for i in pieces}

    def words(run):
        return sum(len(re.findall(r"[^ \t\n]+", x)) for x in run)

    for i in sorted(pieces):
        f = full[i]
        for s in range(len(f)):
            for n in range(min(span, len(f)), len(f) - s + 1):
                run = tuple(pieces[i][j].strip(" \t\n") for j in f[s:s + n])
                if words(run) >= min_words:
                    if run in seen:
                        gone[i].update(f[s:s + n])
                    seen.add(run)
                    break
    return {i: (len(full[i]), len(gone[i]), "".join(x for j, x in enumerate(pieces[i]) if j not in gone[i]))
            for i in pieces}
