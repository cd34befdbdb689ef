"""Packing by power-of-two decomposition of documents.

A document of ``n`` tokens is cut into pieces whose lengths are the powers of
two of ``n``'s binary form (whole ``max_length`` pieces first).  Pieces of one
length form a bucket; every piece is a sequence of its own, so no sequence
crosses documents and none needs padding.

Null text counts as empty (a piece with the end id alone).  Null ids are kept;
repeated rows are packed once per row.  An empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rekko.llm.common import id_type, slices, texts_only

# Split pattern of byte-level BPE files that use the library's own pattern (fixed value).
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
# Characters outside the blocks whose letters, digits and spaces every Unicode version classes alike.
UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\xa0-ɏΑ-ΡΣ-ϿЀ-ҁҊ-ԣ"
                     r"‐-‧‰-⁞₠-₵ぁ-ゖァ-ヺ一-龥가-힣]")


class ByteLevelEncoder:
    """Ids as ``tokenizers`` gives them with the JSON file.

    With the same vocabulary's rank file, texts of ordinary characters take
    the faster rank encoder, which gives the same ids (tested); texts with
    added-token strings or unusual characters always take the JSON file.
    """

    def __init__(self, path: str, ranks_path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranks = rank_encoding(ranks_path) if ranks_path else None

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.ranks is None or UNUSUAL.search(text) or any(a in text for a in self.added):
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        else:
            ids = self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
        return ids.tobytes()


def rank_encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=2)
def encoder(path: str, ranks_path: str | None = None) -> ByteLevelEncoder:
    return ByteLevelEncoder(path, ranks_path)


def piece_lengths(n: int, max_length: int) -> list[int]:
    """Whole ``max_length`` pieces, then the powers of two of the rest, largest first."""
    rest = n % max_length
    return [max_length] * (n // max_length) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None,
         max_length: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids`` (little-endian unsigned
    32-bit), ``doc_tokens``, ``bucket`` (log2 of the length), ``sequence_id``, ``offset``.

    ``max_length`` must be a power of two.  ``sequence_id`` is unique over the
    result; each piece fills its sequence, so ``offset`` is 0.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    longs = ("start", "length", "doc_tokens")
    schema = T.StructType([T.StructField(id_col, id_type(docs, id_col)),
                           *(T.StructField(c, T.LongType()) for c in longs),
                           T.StructField("bucket", T.IntegerType()), T.StructField("ids", T.BinaryType())])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, ranks_path).encode
        for batch in batches:
            for part in slices(batch, 4_000_000):
                row, start, length, total, ids = [], [], [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    data = encode(text) + end
                    at, n = 0, len(data) // 4
                    for size in piece_lengths(n, max_length):
                        row.append(i)
                        start.append(at)
                        length.append(size)
                        total.append(n)
                        ids.append(data[4 * at:4 * (at + size)])
                        at += size
                size = np.array(length, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int32())), pa.array(start, pa.int64()),
                     pa.array(size), pa.array(total, pa.int64()),
                     pa.array(np.log2(size).astype(np.int32)), pa.array(ids, pa.binary())],
                    names=schema.names)

    return (texts_only(docs, id_col, text_col).mapInArrow(run, schema)
            .withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write the sequences as Parquet, one folder for each length."""
    packed.write.mode("overwrite").partitionBy("bucket").parquet(path)


def piece_digests(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return packed.select(id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
