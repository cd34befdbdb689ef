"""The pipeline, stage by stage, and the registered queries."""

import random

import corpus_pipeline
import numpy as np
import pytest
from brute import components, cut, fingerprint

from rekko.llm import pii
from rekko.llm.queries import BYTES, ORACLE, QUERIES
from rekko.llm.queries import tokenizer as tokenizer_path

SF = "/root/testdata/sf0.001"


def test_stages_have_the_agreed_order_and_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "suffix_array", "pii", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
        docs = out
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_stages_against_brute_force(spark, make_docs, odd_rows):
    rng = random.Random(9)
    rows = [(i, t) for i, t in odd_rows if i not in (None, 105, 106)]
    rows += [(400 + i, rows[i][1]) for i in range(10)]
    rows += [(500, "write to a@b.c now " + "".join(rng.choice("abc ") for _ in range(100)))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    fps = [fingerprint(t) for _, t in rows]
    want = set(components(fps, [i for i, _ in rows]))
    assert {r["doc_id"] for r in kept.collect()} == want
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    cutted = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeated_bytes(spark, kept, SF).collect()}
    for (i, t), (n, gone, _, _) in zip(left, cut(left), strict=True):
        size = len(cutted[i].encode())
        assert n - gone - 6 <= size <= n - gone, i      # less the parts of characters at the cuts
    clean = corpus_pipeline.redact_personal_data(spark, docs, SF).filter("doc_id = 500").first()
    assert "[EMAIL]" in clean["text"] and clean["n_chars"] == len(clean["text"])
    assert not any(s["base"] for s in pii.spans_of(clean["text"]))


def test_the_last_stage_holds_every_id(spark):
    """A document's ids put together from its sequences are those of the public tokenizer, then 0."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = corpus_pipeline.pack_sequences(spark, docs, SF).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path(BYTES))
    tokenizer.encode_special_tokens = True
    pieces = {}
    for r in found:
        assert r["length"] == 1 << r["bucket"] and len(r["ids"]) == 4 * r["length"] and r["length"] <= 1024
        pieces.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], dtype="<u4")))
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = np.concatenate([x for _, x in sorted(pieces[doc_id], key=lambda x: x[0])]).tolist()
        assert ids == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("labels", [
    [(i, 1) for i in range(40)], [(i, 0) for i in range(40)], [(i, int(i < 20)) for i in range(40)], []])
def test_nothing_learned_drops_nothing(spark, tmp_path, labels):
    """Labels of one class, too few different texts of a class, no labels: every document passes."""
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame([(i, "the same clean text" if i < 20 else f"clean text {i}", "en", "s", 20)
                                  for i in range(40)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert kept.dtypes == docs.dtypes
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(40))


def test_empty_documents_pass_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = out if out.columns == docs.columns else docs


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_statements(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert got.equals(want)
