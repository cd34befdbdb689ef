"""Fill-in-middle transformation: a document is cut at two unit boundaries and its parts reordered.

Units are lines (with their newline), words (with the blanks before them) or
sentences; units join to the text.  Every character becomes a symbol: its class
(newline, blank, sentence mark, other) and whether a blank or the end of the
text follows.  A wavelet matrix over the symbols of a slice of documents answers all
questions about boundaries: a unit ends behind certain symbols, so their ranks add up to the
number of boundaries before a position, and bisection on ranks finds both cuts.

The two cuts, the form and their randomness come from a hash of ``seed`` and id,
so a document is cut alike in every run.  Prefix is everything before the first
cut, middle what lies between them, suffix the rest.  Forms: ``psm`` (prefix,
suffix, middle), ``spm`` (suffix, prefix, middle) and ``plain`` (the text as it is).
The marks cannot arise at a seam, so ``restore`` gets the exact text back.

Null text is an empty one.  An empty text, and one that holds a mark, stays plain.
A null id is hashed as the empty string.  Repeated rows get equal results, an empty
table gives no rows, and extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekko.llm.common import map_texts
from rekko.llm.wavelet import WaveletMatrix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Symbol = 2 x class + (a blank or the end of the text follows).
NEWLINE, BLANK, MARK, OTHER = range(4)
BITS = 3
# The symbols that a unit ends behind.
ENDS = {
    "line": (2 * NEWLINE, 2 * NEWLINE + 1),
    "word": (2 * MARK + 1, 2 * OTHER + 1),
    "sentence": (2 * NEWLINE, 2 * NEWLINE + 1, 2 * MARK + 1),
}
FIELDS = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
          T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
          T.StructField("output", T.StringType()), T.StructField("restored", T.StringType())]


def class_table() -> np.ndarray:
    table = np.full(128, OTHER, dtype=np.uint8)
    table[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = BLANK
    table[0x0A] = NEWLINE
    table[[ord(c) for c in ".!?"]] = MARK
    return table


CLASSES = class_table()


class Boundaries:
    """Unit boundaries of the documents of a slice; positions are those of the joined slice."""

    def __init__(self, texts: list[str], unit: str):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.start = np.concatenate(([0], np.cumsum(sizes)))
        chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        classes = CLASSES[np.minimum(chars, 127)]
        follows = np.ones(len(classes), dtype=np.uint8)
        follows[:-1] = classes[1:] <= BLANK
        follows[self.start[1:][sizes > 0] - 1] = 1
        self.ends, self.matrix = ENDS[unit], WaveletMatrix(2 * classes + follows, BITS)
        first, last = self.start[:-1], self.start[1:]
        self.base = self.matrix.rank_any(self.ends, first)
        self.closed = self.matrix.rank_any(self.ends, last) - self.base
        # what stands behind the last boundary is a unit too
        open_tail = self.matrix.rank_any(self.ends, np.maximum(last - 1, 0)) - self.base == self.closed
        self.n = self.closed + ((sizes > 0) & open_tail)

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Characters in each document's first ``units`` units."""
        first, last = self.start[:-1], self.start[1:]
        inside = np.minimum(units, self.closed)
        at = self.matrix.select_any(self.ends, self.base + inside, first, last)
        return np.where(units > self.closed, last, at) - first


def draws(doc_id: int | None, seed: int) -> tuple[int, ...]:
    """Four 32-bit numbers from the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))


def arranged(text: str, form: str, a: int, b: int) -> str:
    """The text in its form; prefix ends at ``a``, middle at ``b``."""
    if form == "psm":
        return f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"
    if form == "spm":
        return f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"
    return text


def restore(output: str, form: str) -> str:
    """The text behind an output of :func:`arranged`."""
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE, 1)
    if form == "psm":
        prefix, suffix = head.removeprefix(PREFIX).split(SUFFIX, 1)
    else:
        suffix, prefix = head.removeprefix(SUFFIX).split(PREFIX, 1)
    return prefix + middle + suffix


def transform_texts(texts: list[str], ids: list, unit: str, seed: int, rate: int, spm_rate: int) -> list[pa.Array]:
    bounds = Boundaries(texts, unit)
    h = np.array([draws(i, seed) for i in ids], dtype=np.int64).reshape(-1, 4)
    one, two = h[:, 0] % (bounds.n + 1), h[:, 1] % (bounds.n + 1)
    first, second = bounds.cut(np.minimum(one, two)), bounds.cut(np.maximum(one, two))
    rows = []
    for text, a, b, h3, h4 in zip(texts, first.tolist(), second.tolist(), *(h[:, i].tolist() for i in (2, 3)),
                                  strict=True):
        plain = not text or h3 % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE))
        form = "plain" if plain else "spm" if h4 % 100 < spm_rate else "psm"
        output = arranged(text, form, a, b)
        rows.append((form, None if plain else a, None if plain else b - a, output, restore(output, form)))
    form, a, b, output, restored = zip(*rows, strict=True)
    return [pa.array(bounds.n, pa.int64()), pa.array(form, pa.string()), pa.array(a, pa.int64()),
            pa.array(b, pa.int64()), pa.array(output, pa.string()), pa.array(restored, pa.string())]


def fill_in_middle(docs: DataFrame, unit: str = "line", seed: int = 7, rate: int = 100, spm_rate: int = 50,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n`` units, ``form``, ``prefix_chars`` and ``middle_chars`` (null if plain),
    ``output`` and ``restored``, the text rebuilt from it.

    ``rate`` percent of the documents are cut, ``spm_rate`` percent of those as ``spm``.
    """
    if unit not in ENDS:
        raise ValueError(f"unit must be one of {', '.join(ENDS)}")

    def make(texts: list[str], ids: list) -> list[pa.Array]:
        return transform_texts(texts, ids, unit, seed, rate, spm_rate)

    return map_texts(docs, id_col, text_col, FIELDS, make, 2_000_000, with_ids=True)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, "n", "form", "prefix_chars", "middle_chars",
                        F.sha2("output", 256).alias("output_sha256"),
                        F.sha2("restored", 256).alias("restored_sha256"))
