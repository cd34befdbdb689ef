"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An automaton lists the pieces that end at each position of a part; the search
keeps, for each position, the best score and the number of pieces on its path,
nothing else.  Tie rule of the unigram tokenizer: of equal scores the path
found first wins, that is the one whose last piece begins first (the longest).
A character without a piece costs the lowest score less ``UNKNOWN_PENALTY`` and
counts as its UTF-8 bytes.

The vocabulary is that of a public piece model (text pieces and their scores),
read as a unigram model.  Scores are summed in double precision, where the
integer scores of these files are exact, so parts that no piece crosses can be
counted on their own.

Null text counts as empty (no tokens).  Rows repeat as they come; an empty
table gives no rows.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rekko.llm.common import BoundedCache, map_texts
from rekko.llm.pieces import Vocabulary, escape, load, splitter

UNKNOWN_PENALTY = 10.0  # fixed value of unigram tokenizers
LOWEST = float("-inf")


class ViterbiCounter:
    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.ids, self.split = vocabulary.ids, splitter(vocabulary)
        self.unknown = min(vocabulary.scores.values()) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for p, s in vocabulary.scores.items():
            self.automaton.add_word(p, (len(p), float(s)))
        self.automaton.make_automaton()
        self.parts = BoundedCache(self.part)

    def part(self, part: str) -> int:
        """Pieces on the best path.  Matches come by their end, longest first, which is
        the order of their starts, so a later one must be strictly better."""
        if len(part) == 1:
            return 1 if part in self.ids else len(part.encode())
        best, count = [LOWEST] * (len(part) + 1), [0] * (len(part) + 1)
        best[0] = 0.0
        for last, (size, s) in self.automaton.iter(part):
            start, end = last + 1 - size, last + 1
            s += best[start]
            if s > best[end]:
                best[end], count[end] = s, count[start] + 1
        return count[-1]

    def count(self, text: str) -> int:
        parts = self.parts
        return sum([parts[p] for p in self.split(escape(text))])


@functools.lru_cache(maxsize=2)
def counter(path: str) -> ViterbiCounter:
    return ViterbiCounter(load(path))


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``n_tokens``."""
    def make(texts: list[str]) -> list[pa.Array]:
        count = counter(model_path).count
        return [pa.array(np.array([count(t) for t in texts], dtype=np.int64))]

    return map_texts(docs, id_col, text_col, [T.StructField("n_tokens", T.LongType())], make)
