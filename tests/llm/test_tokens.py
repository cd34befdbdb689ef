"""Piece encoding, unigram counts and packing against the public libraries."""

import random
import zlib

import numpy as np
import pytest
from brute import sha

from rekko.llm import packing, sentencepiece_bpe, token_counts
from rekko.llm.pieces import escape, load

public_tokenizers = pytest.importorskip("public_tokenizers")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))


def fuzz(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    alphabet = "abcdeéñß  \n\t.,;:!?▁0123日本の😀\x00́\x1c\x85thertheing<>/s'"
    pieces = [p.replace("▁", " ") for p in load(PIECES).ids]
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]
    out += ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(n)]
    out += [" " * i + "word" + " " * i for i in range(40)] + [" " * i for i in range(40)]
    return out + ["", "<s> </s> <0x0A> <unk>", "a" * 5000, "ab" * 3000 + " " * 500, "日" * 2000, "<|endoftext|> x"]


def test_piece_ids_and_text_are_the_librarys():
    from sentencepiece import SentencePieceProcessor

    sp, table = SentencePieceProcessor(model_file=PIECES), sentencepiece_bpe.prefix_table(PIECES)
    for text in fuzz(4000, 1):
        ids = np.frombuffer(table.encode(text), dtype="<i4").tolist()
        assert ids == sp.encode(text), text
        assert table.decode(ids + [2]) == sp.decode(ids + [2]), text
    rng = random.Random(2)
    for _ in range(1000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(262) for _ in range(rng.randrange(8))]
        assert table.decode(ids) == sp.decode(ids), ids


def test_piece_query_columns(make_docs, odd_rows):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=PIECES)
    got = sentencepiece_bpe.token_digests(sentencepiece_bpe.encode_decode(make_docs(odd_rows), PIECES)).collect()
    want = []
    for i, t in odd_rows:
        ids = sp.encode(t or "", add_eos=True)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_counts_are_those_of_a_unigram_tokenizer():
    from tokenizers import Tokenizer, models

    v, count = load(PIECES), token_counts.counter(PIECES)
    pieces = [("<unk>", 0.0)] + [(f"<0x{b:02X}>", -1e12) for b in range(256)] + list(v.scores.items())
    unigram = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    for text in fuzz(1500, 3):
        if len(text) < 1000:    # the library's search is slow on long texts
            want = len(unigram.encode(escape(text)).ids) if text else 0
            assert count.count(text) == want, text


def test_byte_ids_are_the_librarys():
    from tokenizers import Tokenizer

    tokenizer, both = Tokenizer.from_file(BYTES), packing.encoder(BYTES, RANKS)
    for text in [*fuzz(3000, 4), "' s 's x''s", "x \n y\r\n\r\n  z ", "²³¼ ª º", " \x1f a"]:
        ids = np.frombuffer(both.encode(text), dtype="<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_packing(make_docs, odd_rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTES)
    rows = [(i, t) for i, t in odd_rows if i not in (None, 105, 106)]
    packed = packing.pack(make_docs(rows), BYTES, RANKS)
    got = packing.piece_digests(packed).collect()
    assert len({r["sequence_id"] for r in got}) == len(got) and {r["offset"] for r in got} == {0}
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
        assert sum(r["length"] for r in own) == len(ids) == own[0]["doc_tokens"]
        at = 0
        for r in own:
            assert r["start"] == at and r["length"] in [1 << b for b in range(11)]
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        # as few pieces as the binary form has: no padding
        assert len(own) == len(ids) // 1024 + (len(ids) % 1024).bit_count()


def test_packing_buckets_and_odd_rows(make_docs, odd_rows, spark, tmp_path):
    packed = packing.pack(make_docs(odd_rows), BYTES)
    packing.write_buckets(packed, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.filter("length != pow(2, bucket)").count() == 0 and back.count() == packed.count()
    with pytest.raises(ValueError):
        packing.pack(make_docs([]), BYTES, max_length=1000)


@pytest.mark.parametrize("run", [
    lambda d: sentencepiece_bpe.encode_decode(d, PIECES), lambda d: token_counts.count_tokens(d, PIECES),
    lambda d: packing.pack(d, BYTES, RANKS)])
def test_empty_tables(make_docs, run):
    assert run(make_docs([])).collect() == []
    assert len(run(make_docs([(None, None)])).collect()) == 1


def test_odd_rows_are_counted(make_docs, odd_rows):
    got = token_counts.count_tokens(make_docs(odd_rows), PIECES).collect()
    count = token_counts.counter(PIECES).count
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, count(t or ""))) for i, t in odd_rows)
