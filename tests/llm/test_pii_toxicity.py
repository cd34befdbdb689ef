"""Personal data against plain regular expressions; toxicity on held-out labels."""

import random

import pytest
from brute import base_spans, sha

from rekko.llm import pii, toxicity


def digest(spans):
    return sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))


def test_base_spans_on_random_texts():
    rng = random.Random(1)
    for _ in range(30000):
        text = "".join(rng.choice("a@..b1234567890+ -()@é%_") for _ in range(rng.randrange(50)))
        assert pii.base_spans(text) == base_spans(text), text
    for _ in range(3000):
        text = " ".join(rng.choice(["4720843956327690", "+1 (826) 555-4081", "1.2.3.4", "256.1.1.1", "00.0.0.0255",
                                    "a.b@c-d.example", "x@y", "4111 1111 1111 1111", "1-2-3"]) for _ in range(6))
        assert pii.base_spans(text) == base_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "+1" * 100_000, "1." * 100_000, "1 " * 100_000):
        pii.spans_of(text)


def test_added_spans():
    text = "Pay to IBAN GB82 WEST 1234 5698 7654 32 or DE00 1234 5678 9012 3456 78; call 555-123-4567 or 5551 4444 1234"
    found = {(s["kind"], text[s["start"]:s["end"]]) for s in pii.spans_of(text) if not s["base"]}
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in found
    assert not any(t.startswith("DE00") for _, t in found)
    assert ("phone", "555-123-4567") in found
    assert not any(s["kind"] == "phone" for s in pii.spans_of("The year 2019-123-4567 was long"))
    assert pii.redact("mail a@b.c or 1.2.3.4!", pii.spans_of("mail a@b.c or 1.2.3.4!")) == "mail [EMAIL] or [IP]!"
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB83WEST12345698765432")


@pytest.mark.parametrize("text, want", [
    ("GB82 WEST 1234 5698 7654 32 DE89 3704 0044 0532 0130 00",
     ["GB82 WEST 1234 5698 7654 32", "DE89 3704 0044 0532 0130 00"]),
    ("AB12 INVOICE DE89370400440532013000", ["DE89370400440532013000"]),
    ("AB12 CD34 GB82WEST12345698765432 XY56 DE89370400440532013000 END",
     ["GB82WEST12345698765432", "DE89370400440532013000"]),
    ("XDE89370400440532013000 DE00370400440532013000", [])])
def test_ibans_behind_others(text, want):
    assert [text[a:b] for kind, a, b in pii.added_spans(text, []) if kind == "iban"] == want


def test_iban_starts_take_linear_time():
    for text in ("AA11 " * 30_000, "AA11" * 30_000, "AA11BB22CC33DD44 " * 8_000):
        pii.spans_of(text)


def test_pii_query(make_docs, odd_rows):
    rows = [(i, t) for i, t in odd_rows if i not in (105, 106)]
    rows += [(900, "é a@b.c 1.2.3.4 4720843956327690 +1 (826) 555-4081 x@y.zz"), (901, "a@b.c" * 3)]
    got = pii.span_digests(pii.find_pii(make_docs(rows)))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    want = []
    for i, t in rows:
        b = base_spans(t)
        want.append((i, *(sum(k == kind for k, _, _ in b) for kind in pii.BASE_KINDS), digest(b)))
    assert sorted(repr(tuple(r)[:-1]) for r in got.collect()) == sorted(map(repr, want))
    for r in got.collect():
        if r["doc_id"] == 900:
            assert all(f"{k}:{a}:{b}" in r["spans"].split(",") for k, a, b in base_spans(rows[-2][1]))


@pytest.fixture(scope="module")
def labelled(make_docs, spark):
    rng = random.Random(5)
    syllables = ["ka", "lo", "mi", "ter", "sun", "rel", "po", "vin", "das", "qui"]
    bad = ["wretch", "villain", "coward", "scoundrel"]

    def prose(n):
        return ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5))) for _ in range(n)]

    rows, labels = [], []
    for i in range(1600):
        words = prose(rng.randrange(40, 160))
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    labels += [(5000, 1), (None, 1), (3, None)]
    return rows, labels, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_rows(make_docs, labelled):
    rows, labels, label_df = labelled
    docs = make_docs(rows + [(7000, None), (7001, ""), (None, "ka lo mi"), (7002, "ka " * 100_000)])
    model = toxicity.fit(docs, label_df)
    got = toxicity.toxicity(docs, model).collect()
    assert len(got) == docs.count()
    known = dict(labels)
    held = [r for r in got if r["held_out"] and r["doc_id"] in known]
    assert len(held) > 200
    right = sum(r["predicted"] == known[r["doc_id"]] for r in held)
    caught = [r["predicted"] for r in held if known[r["doc_id"]]]
    assert right >= 0.97 * len(held) and sum(caught) >= 0.9 * len(caught)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    kept = docs.filter(toxicity.score_column(model) < 0.3)
    assert kept.columns == docs.columns and kept.count() == sum(1 - r["predicted"] for r in got)


def test_held_out_rows_are_never_learned_from(make_docs, labelled):
    import zlib

    rows, labels, label_df = labelled
    docs = make_docs(rows)
    swapped = label_df.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    assert toxicity.fit(docs, swapped) == toxicity.fit(docs, label_df)
    out = {r["doc_id"]: r["held_out"] for r in toxicity.toxicity(docs, toxicity.fit(docs, label_df)).collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in out.items())


def test_nothing_to_learn(make_docs, spark):
    docs = make_docs([(1, "a"), (2, None), (None, "b")])
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    one = toxicity.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.toxicity(docs, one).collect()} == {1.0}
    assert toxicity.toxicity(make_docs([]), none).collect() == []
    few = toxicity.fit(docs, spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int"))
    assert all(0 <= r["score"] <= 1 for r in toxicity.toxicity(docs, few).collect())
    assert pii.find_pii(make_docs([])).collect() == []


def test_train_stride_thins_long_texts(monkeypatch):
    """With a stride no text reaches, the ordinary dictionary is trained on every window."""
    import zstandard

    rng = random.Random(8)
    texts = [" ".join(rng.choice(["oak", "elm", "ash", "fir", "yew"]) + str(rng.randrange(99)) for _ in range(400))
             for _ in range(9)]
    sizes = []
    monkeypatch.setattr(zstandard, "train_dictionary", lambda n, samples: sizes.append(len(samples)) or
                        zstandard.ZstdCompressionDict(b"".join(samples)[:n]))
    for stride in (256, 10 ** 9):
        toxicity.train(texts[:3], texts[3:], 0.5, train_stride=stride)
    assert sizes[1] == sum(len(toxicity.windows(t)) for t in texts[3:7]) > 5 * sizes[0]


def test_many_spans_in_one_text_take_linear_time():
    """100,000 spans of base and added kinds; each added span is compared with its neighbour only."""
    import time

    text = "call 555 123 4567 or a@b.co GB82 WEST 1234 5698 7654 32; "
    began = time.time()
    few = pii.spans_of(text * 3_400)
    middle = time.time()
    many = pii.spans_of(text * 34_000)
    assert len(many) == 10 * len(few) and len(many) > 100_000
    assert time.time() - middle < 30 * (middle - began) + 1


def test_added_spans_touch_no_other():
    """Against the comparison of every pair."""
    rng = random.Random(4)
    parts = ["a@b.co", "+49 30 123 456 78", "GB82 WEST 1234 5698 7654 32", "555 123 4567", "4111-1111-1111-1111",
             "4111.1111.1111.1111", "1.2.3.4", "phone", "iban", " ", "-", "7"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        base = pii.base_spans(text)
        added = pii.added_spans(text, base)
        for i, (_, a, b) in enumerate(added):
            assert all(b <= c or a >= d for _, c, d in [*base, *added[:i]])
