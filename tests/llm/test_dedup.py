"""SimHash, suffix-array and sentence-span dedup against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import components, cut, fingerprint, sha, span_dedup
from hypothesis import given, settings
from hypothesis import strategies as st

from rekko.llm import sentence_spans, simhash, suffix_array, suffix_sort


def test_fingerprints_and_components(make_docs, odd_rows):
    got = simhash.hex_fingerprints(simhash.near_duplicates(make_docs(odd_rows))).collect()
    fps = [fingerprint(t) for _, t in odd_rows]
    want = Counter((i, f"{f:016x}", c) for (i, _), f, c in
                   zip(odd_rows, fps, components(fps, [i for i, _ in odd_rows]), strict=True))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


@pytest.mark.parametrize("max_bits", [0, 1, 3, 5, 7])
def test_links_of_long_lists(spark, max_bits):
    """Lists beyond ``list_size`` are cut into blocks; no connection is lost."""
    rng = random.Random(max_bits)
    base = [rng.getrandbits(64) for _ in range(4)]
    fps = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (2 ** 64 - 1)
                  for b in base for _ in range(60)})
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    found = simhash.components(simhash.links(df, max_bits, list_size=16))
    root = {r["fp"]: r["root"] for r in found.collect()}
    groups = defaultdict(set)
    for f in fps:
        s = int(np.uint64(f).astype(np.int64))
        groups[root.get(s, s)].add(f)
    want = defaultdict(set)
    for f, c in zip(fps, components(fps, fps, max_bits), strict=True):
        want[c].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_keep_one(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    fps = [fingerprint(t) for _, t in odd_rows]
    groups = components(fps, [i for i, _ in odd_rows])
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(groups) - {None})


@pytest.mark.parametrize("hot", [False, True])
def test_suffix_array_dedup(make_docs, odd_rows, monkeypatch, hot):
    if hot:     # every repeated anchor is replaced by its windows
        monkeypatch.setattr(suffix_array, "HOT_LEAST", 1)
        monkeypatch.setattr(suffix_array, "HOT_SHARE", 1e-9)
    found = suffix_array.dedup_bytes(make_docs(odd_rows), 50).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], sha(bytes(r["kept"]))) for r in found)
    assert got == Counter((i, *x) for (i, _), x in zip(odd_rows, cut(odd_rows), strict=True))


def test_suffix_array_near_copies(make_docs):
    """Copies with single edits share windows on one side of an anchor or the other only."""
    rng = random.Random(3)
    base = "".join(rng.choice("abcd ") for _ in range(400))
    rows = []
    for i in range(60):
        s = list(base)
        for _ in range(rng.randrange(8)):
            s[rng.randrange(len(s))] = rng.choice("abcdé")
        rows.append((rng.randrange(40), "".join(s)))
    rows = list(dict(rows).items())
    found = suffix_array.dedup_bytes(make_docs(rows, clash=False), 50).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], sha(bytes(r["kept"]))) for r in found)
    assert got == Counter((i, *x) for (i, _), x in zip(rows, cut(rows), strict=True))


def test_suffix_array_nul_bytes(make_docs):
    """Runs of NUL bytes are not taken for the padding behind shorter strings."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        middle = "".join(rng.choice("ab") for _ in range(rng.randrange(3)))
        rows.append((i, "\0" * rng.randrange(60) + middle + "\0" * rng.randrange(60) + rng.choice(["", "a", "b"])))
    found = suffix_array.dedup_bytes(make_docs(rows, clash=False), 50).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], sha(bytes(r["kept"]))) for r in found)
    assert got == Counter((i, *x) for (i, _), x in zip(rows, cut(rows), strict=True))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(c % 2 for c in b)), max_size=30))
def test_equal_padded_strings_by_length(items):
    strings = np.zeros((len(items), 40), np.uint8)
    for i, b in enumerate(items):
        strings[i, :len(b)] = list(b)
    groups, sizes = np.zeros(len(items), np.int64), np.array([len(b) for b in items], dtype=np.int64)
    for shallow in (0, 8, 24):
        order = suffix_sort.deep_shallow(strings, groups, shallow, sizes)
        assert [items[i] for i in order] == sorted(items)


def test_equal_windows_across_a_shorter_string():
    """Two equal windows of NUL bytes with a shorter string between them."""
    gram = bytes(range(1, 21))
    long_, short = b"\0" * 3 + gram + b"\0" * 30, b"\0" + gram + b"\0" * 30
    late = suffix_array.equal_windows(np.array([1, 2, 3]), np.zeros(3, np.int64), np.array([4, 2, 4]),
                                      np.array([3, 1, 3]), [long_, short, long_], 50)
    assert late[:, :4].tolist() == [[False] * 4, [True, True, False, False], [True] * 4]


def test_spans_covered_in_a_batch_stay_out_of_the_buckets(spark, make_docs, monkeypatch):
    """A passage that stands in every row reaches its bucket once; the other spans come in rows of a
    bounded size, each under a key of its own."""
    monkeypatch.setattr(suffix_array, "COVERED_SPANS", 100, raising=False)
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(50))
    rows = [(i, passage) for i in range(2000)]
    keyed = suffix_array.keyed(make_docs(rows).coalesce(1), "doc_id", "text").select(
        "k", suffix_array.tag_of(suffix_array.F.col("t")).alias("tag"), "text")
    dealt = suffix_array.deal(keyed, 50, np.zeros(0, np.uint64), 1).collect()
    judged = [r for r in dealt if r["bucket"] >= 0]
    assert sum(len(suffix_array.unpack(r["segments"], suffix_array.PACKED)[0]) for r in judged) == len(judged)
    late = [r for r in dealt if r["bucket"] < 0]
    sizes = [len(suffix_array.unpack(r["covered"], suffix_array.COVERED)[0]) for r in late]
    assert not any(r["covered"] for r in judged)
    assert max(sizes) <= 100 and sum(sizes) == 2000 - len(judged)
    assert len({r["bucket"] for r in late}) == len(late)
    found = suffix_array.dedup_bytes(make_docs(rows), 50).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in found) == [(i, 50 * (i > 0)) for i in range(2000)]


def test_long_text_in_blocks(monkeypatch):
    """A text longer than a block gives the same windows, each once."""
    monkeypatch.setattr(suffix_array, "BLOCK", 256)
    text = bytes(random.Random(1).choice(b"abc ") for _ in range(2000))
    found = suffix_array.segments([text, b"short", text[:700]], 50, None)
    for doc, n in ((0, 2000), (1, 5), (2, 700)):
        own = found.take(found.doc == doc)
        seen = sorted(s + i for s, c in zip(own.start.tolist(), own.count.tolist(), strict=True) for i in range(c))
        assert seen == list(range(max(0, n - 49)))


def test_whole_rows_drop_broken_characters(make_docs):
    shared = "é" * 40
    rows = [(1, "a" + shared + "b"), (2, "cè" + shared + "d")]
    docs = make_docs(rows)
    out = suffix_array.dedup_bytes(docs, 50, whole_rows=True)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: rows[0][1], 2: "cèd"}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.binary(max_size=24).map(lambda b: bytes(c % 3 for c in b))),
                max_size=40))
def test_deep_shallow_sort(items):
    groups = np.array([g for g, _ in items], dtype=np.int64)
    strings = np.zeros((len(items), 24), np.uint8)
    for i, (_, b) in enumerate(items):
        strings[i, :len(b)] = list(b)
    for shallow in (0, 8, 16):
        order = suffix_sort.deep_shallow(strings, groups, shallow)
        rows = [(groups[i], strings[i].tobytes()) for i in order]
        assert sorted(order.tolist()) == list(range(len(items)))
        assert rows == sorted(rows)
        sizes = np.array([len(b) for _, b in items], dtype=np.int64)
        common = suffix_sort.common_prefixes(strings, sizes, groups, order)
        for at in range(1, len(order)):
            a, b = order[at - 1], order[at]
            if groups[a] == groups[b]:
                lcp = next((j for j in range(24) if strings[a, j] != strings[b, j]), 24)
                assert common[at] == min(lcp, sizes[a], sizes[b])


@pytest.mark.parametrize("span,min_words", [(2, 12), (3, 0), (1, 5), (2, 40)])
def test_sentence_spans(make_docs, odd_rows, span, min_words):
    rows = [(i, t or "") for i, t in odd_rows if i is not None and i != 106]
    rows += [(i, "THE!! Oh.\nSo it is. " * (i % 3) + "A few\twords here. And then some more of them, all the same. End.")
             for i in range(500, 506)] + [(510, "one sentence of words that has more than twelve words in it all"),
                                          (511, "one sentence of words that has more than twelve words in it all")]
    rows = list(dict(rows).items())
    got = {r["doc_id"]: (r["n_sentences"], r["n_removed"], r["kept"])
           for r in sentence_spans.dedup_sentences(make_docs(rows), span, min_words).collect()}
    assert got == span_dedup(rows, span, min_words)


def test_sentence_spans_odd_rows(make_docs, odd_rows):
    got = sentence_spans.dedup_sentences(make_docs(odd_rows)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in odd_rows)
    twice = [r for r in got if r["doc_id"] == 105]
    assert twice[0] == twice[1]


@pytest.mark.parametrize("run", [
    lambda d: simhash.near_duplicates(d), lambda d: simhash.keep_one(d),
    lambda d: suffix_array.dedup_bytes(d), lambda d: sentence_spans.dedup_sentences(d)])
def test_empty_tables(make_docs, run):
    assert run(make_docs([])).collect() == []
    assert len(run(make_docs([(None, None)])).collect()) == 1
