"""SentencePiece BPE encoding and decoding with a prefix table.

For every prefix of a part of the text there is exactly one token that can end
its encoding.  An automaton lists the pieces that end at each position; the
one whose pair with the last token of the prefix before it survives BPE's own
merge order is stored.  Ids are then read backwards from the table, in linear
time however long the part is.

Null text counts as empty (the end id alone).  Rows repeat as they come; an
empty table gives no rows.  Characters without a piece become byte pieces.
"""

from __future__ import annotations

import functools
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekko.llm.common import BoundedCache, map_texts
from rekko.llm.pieces import SPACE, Vocabulary, escape, load, splitter


class PrefixTable:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.v = vocabulary
        self.split = splitter(vocabulary, cut_spaces=True)
        self.merged: dict[tuple[int, int], int] = {}    # pair of ranks -> rank of its merge
        self.halves: list[tuple[int, int]] = []         # rank -> the pair merged last (itself: a character)
        self.rank_id: list[int] = []
        self.fits: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        self._rank_pieces()
        self.automaton.make_automaton()
        self.rank_bytes = [i.to_bytes(4, "little") for i in self.rank_id]
        self.parts = BoundedCache(self.part)

    def _rank_pieces(self) -> None:
        """Ranks: characters first, then merges by falling score; a merge's halves are
        the two tokens its own text is left with before it."""
        ids, scores = self.v.ids, self.v.scores
        self.rank: dict[str, int] = {}
        single = [p for p in ids if len(p) == 1]
        # runs of spaces all have one score; spaces() merges them by position
        longer = sorted((p for p in ids if len(p) > 1 and p.strip(SPACE)), key=lambda p: (-scores[p], ids[p]))
        if len({scores[p] for p in longer}) < len(longer):
            raise ValueError("merges with equal scores are ranked by position; the prefix table can't hold them")
        for p in [*single, *longer]:
            r = len(self.rank_id)
            if len(p) == 1:
                self.halves.append((r, r))
            else:
                pair = self._last_merge(p, r)
                if pair is None:        # no merge order leads to this piece
                    self.rank_id.append(ids[p])
                    self.halves.append((r, r))
                    continue
                self.halves.append(pair)
                self.merged[pair] = r
            self.rank[p] = r
            self.rank_id.append(ids[p])
            self.automaton.add_word(p, (len(p), r))

    def _last_merge(self, piece: str, r: int) -> tuple[int, int] | None:
        for cut in range(1, len(piece)):
            a, b = self.rank.get(piece[:cut]), self.rank.get(piece[cut:])
            if a is not None and b is not None and self._pair_stands(a, b):
                return a, b
        return None

    def _pair_stands(self, a: int, b: int) -> bool:
        """Whether tokens a, b can stand side by side: undo their merges from the last
        back; no pair across the border may merge before the merge just undone."""
        limit = len(self.rank_id) + 1
        while True:
            joint = self.merged.get((a, b))
            if joint is not None and joint < limit:
                return False
            split_a = self.halves[a][1] != a and (a > b or self.halves[b][0] == b)
            if split_a:
                limit, a = a, self.halves[a][1]
            elif self.halves[b][0] != b:
                # an equal merge further left comes first, so the one undone here is still allowed
                limit, b = b + 1, self.halves[b][0]
            else:
                return True

    def fit(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            known = self.fits[key] = self._pair_stands(a, b)
        return known

    def part(self, part: str) -> bytes:
        """Little-endian 32-bit ids of one part."""
        if part[-1] == SPACE and len(part) > 1:
            return b"".join([i.to_bytes(4, "little") for i in self.spaces(len(part))])
        if len(part) == 1 and part not in self.v.ids:
            return b"".join([self.v.byte_ids[b].to_bytes(4, "little") for b in part.encode()])
        return self.word(part)

    def word(self, part: str) -> bytes:
        """The prefix table of a part (last token and where it starts), read backwards."""
        n = len(part)
        last, begin = [-1] * (n + 1), [0] * (n + 1)
        fits, fit = self.fits, self.fit
        for end, (size, r) in self.automaton.iter(part):
            end += 1
            if last[end] < 0:
                start = end - size
                if start:
                    key = last[start] << 20 | r
                    # a prefix before the start always has its token: ends come in order
                    if not (fits[key] if key in fits else fit(last[start], r)):
                        continue
                    begin[end] = start
                last[end] = r
        out, ids = [], self.rank_bytes
        while n:
            out.append(ids[last[n]])
            n = begin[n]
        out.reverse()
        return b"".join(out)

    def spaces(self, n: int) -> list[int]:
        """A run of spaces: their merges share a score, so the leftmost pair goes first."""
        ids, scores = self.v.ids, self.v.scores
        size, following, before = [1] * n, [*range(1, n), -1], [*range(-1, n - 1)]
        queue: list[tuple[float, int, int]] = []

        def offer(i: int) -> None:
            j = following[i] if i >= 0 else -1
            if j >= 0 and (p := SPACE * (size[i] + size[j])) in ids:
                heapq.heappush(queue, (-scores[p], i, size[i] + size[j]))

        for i in range(n):
            offer(i)
        while queue:
            _, i, total = heapq.heappop(queue)
            j = following[i]
            if not size[i] or j < 0 or size[i] + size[j] != total:
                continue
            size[i], size[j], following[i] = total, 0, following[j]
            if following[j] >= 0:
                before[following[j]] = i
            offer(before[i])
            offer(i)
        return [ids[SPACE * s] for s in size if s]

    def encode(self, text: str) -> bytes:
        parts = self.parts
        return b"".join([parts[p] for p in self._cut(escape(text))])

    def _cut(self, escaped: str) -> list[str]:
        """Parts; a run of spaces whose last one merges with nothing takes that one back."""
        parts = self.split(escaped)
        if SPACE + SPACE not in escaped:
            return parts
        out: list[str] = []
        alone = self.v.ids[SPACE].to_bytes(4, "little")
        for p in parts:
            if out and out[-1][-1] == SPACE and p[0] == SPACE and len(p) > 1 and self.parts[p][:4] == alone:
                out[-1] += SPACE
                p = p[1:]
            out.append(p)
        return out

    @functools.cached_property
    def surface(self) -> list[str | None]:
        """Text of each id; None for a byte beyond ASCII."""
        out: list[str | None] = [p.replace(SPACE, " ") for p in self.v.pieces]
        for b, i in enumerate(self.v.byte_ids):
            out[i] = chr(b) if b < 128 else None
        for i in self.v.controls:
            out[i] = ""
        out[self.v.unknown_id] = " ⁇ "
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: control ids vanish, the dummy space in front goes, runs of byte
        ids become UTF-8 (each byte of a broken sequence a replacement character)."""
        surface = self.surface
        try:
            text = "".join([surface[i] for i in ids])
        except TypeError:
            text = self._decode_bytes(ids)
        lead = next((i for i in ids if i not in self.v.controls), None)
        starts = lead is not None and self.v.pieces[lead].startswith(SPACE)
        return text[1:] if starts else text

    def _decode_bytes(self, ids: list[int]) -> str:
        byte_of, out, run = {i: b for b, i in enumerate(self.v.byte_ids)}, [], bytearray()
        for i in [*ids, -1]:
            if i in byte_of:
                run.append(byte_of[i])
                continue
            if run:
                out.append(utf8(bytes(run)))
                run.clear()
            if i >= 0:
                out.append(self.surface[i])
        return "".join(out)


def utf8(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at:at + n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            n = 1
        at += n
    return "".join(out)


@functools.lru_cache(maxsize=2)
def prefix_table(path: str) -> PrefixTable:
    return PrefixTable(load(path))


def encode_decode(docs: DataFrame, model_path: str, add_end: bool = True,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``ids`` (array of int) and ``decoded`` (text of those ids)."""
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]

    def make(texts: list[str]) -> list[pa.Array]:
        table = prefix_table(model_path)
        end = table.v.end_id.to_bytes(4, "little") if add_end else b""
        encoded = [table.encode(t) + end for t in texts]
        offsets = np.zeros(len(texts) + 1, dtype=np.int32)
        np.cumsum([len(e) // 4 for e in encoded], out=offsets[1:])
        ids = np.frombuffer(b"".join(encoded), dtype="<i4")
        decoded = [table.decode(ids[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), pa.array(decoded, pa.string())]

    return map_texts(docs, id_col, text_col, fields, make, slice_chars=1_000_000)


def token_digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return encoded.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
