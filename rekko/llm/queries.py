"""Registered queries over the corpus operators: thin, with the columns of their contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rekko.llm import (ann, fill_in_middle, line_runs, packing, periodic_runs, pii, sentence_spans, sentencepiece_bpe,
                       simhash, suffix_array, token_counts, topk, toxicity)
from rekko.llm.common import table

PIECES = "piece_bpe_32k.model"
BYTES, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.hex_fingerprints(simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.token_digests(
        sentencepiece_bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer(PIECES)))


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_array.dedup_bytes(table(spark, sf_dir, "documents"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer(PIECES))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), k=20, query_every=20)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(pii.find_pii(table(spark, sf_dir, "documents")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(
        table(spark, sf_dir, "documents"), tokenizer(BYTES), tokenizer(RANKS), max_length=1024, end_id=0))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, query_every=50)


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentence_spans.dedup_sentences(table(spark, sf_dir, "documents"), span=2, min_words=12)
    return found.select("doc_id", "n_sentences", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_runs.dedup_lines(table(spark, sf_dir, "documents"), min_chars=10)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_repeats(table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.collapse_runs(docs, min_words=24, repeats=3))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(
        table(spark, sf_dir, "documents"), unit="line", seed=7, rate=100, spm_rate=50))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_sentencepiece, op3_suffix_array, op4_token_counts, op5_ann,
                                   op6_toxicity, op7_pii, op8_packing, op9_topk, op10_sentence_spans, op11_line_runs, op12_periodic_runs,
                                   op13_fill_in_middle)}

ORACLE = {
    "op9_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w
            FROM (SELECT DISTINCT vec_id, embedding FROM embeddings)
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                list_sum(list_transform(list_zip(a.w, b.w), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.w) = len(b.w) WHERE a.vec_id % 50 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op10_sentence_spans": r"""
        WITH p AS (
            SELECT doc_id, unnest(s) AS piece, generate_subscripts(s, 1) AS i FROM (
                SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?\n]*[.!?\n][.!?\n \t]*|[^.!?\n]+') AS s
                FROM documents)
        ), f AS (
            SELECT doc_id, i, clean, row_number() OVER w AS n, count(*) OVER (PARTITION BY doc_id) AS total,
                sum(words) OVER w AS upto, words
            FROM (SELECT doc_id, i, trim(piece, E' \t\n') AS clean,
                    len(regexp_extract_all(piece, '[^ \t\n]+')) AS words FROM p)
            WHERE clean <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)
        ), e AS (
            SELECT a.doc_id, a.n, min(b.n) AS last FROM f a JOIN f b
                ON a.doc_id = b.doc_id AND b.n BETWEEN a.n + least(a.total, 2) - 1 AND a.n + 11
            WHERE b.upto - a.upto + a.words >= 12 GROUP BY 1, 2
        ), r AS (
            SELECT e.doc_id, e.n, e.last, string_agg(f.clean, chr(10) ORDER BY f.n) AS run
            FROM e JOIN f ON e.doc_id = f.doc_id AND f.n BETWEEN e.n AND e.last GROUP BY 1, 2, 3
        ), l AS (
            SELECT doc_id, n, last, row_number() OVER (PARTITION BY run ORDER BY doc_id, n) AS place FROM r
        ), g AS (
            SELECT DISTINCT f.doc_id, f.i FROM f JOIN l ON f.doc_id = l.doc_id AND f.n BETWEEN l.n AND l.last
            WHERE l.place > 1
        ), k AS (
            SELECT p.doc_id, coalesce(string_agg(piece, '' ORDER BY p.i) FILTER (WHERE g.i IS NULL), '') AS kept
            FROM p LEFT JOIN g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY 1
        )
        SELECT doc_id, coalesce(s.n, 0)::BIGINT AS n_sentences, coalesce(h.n, 0)::BIGINT AS n_removed,
            sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents LEFT JOIN k USING (doc_id)
        LEFT JOIN (SELECT doc_id, count(*) AS n FROM f GROUP BY 1) s USING (doc_id)
        LEFT JOIN (SELECT doc_id, count(*) AS n FROM g GROUP BY 1) h USING (doc_id)""",
    "op11_line_runs": r"""
        WITH l AS (
            SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS i FROM (
                SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)
        ), k AS (
            SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
        ), f AS (
            SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY 1 HAVING count(DISTINCT doc_id) > 1
        ), g AS (
            SELECT k.doc_id, i, line, coalesce(k.doc_id > f.first, false) AS gone FROM k LEFT JOIN f ON k.key = f.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM g GROUP BY 1""",
    "op13_fill_in_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                sha256(concat('7:', doc_id::VARCHAR)) AS x FROM documents
        ), h AS (
            SELECT doc_id, text, u, len(u) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
                ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d
        ), c AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                    OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h
        ), p AS (
            SELECT doc_id, n, form, text, coalesce(array_to_string(u[1:a], ''), '') AS pre,
                coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
                coalesce(array_to_string(u[b + 1:], ''), '') AS suf FROM c
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid)
                ELSE concat('<S>', suf, '<P>', pre, '<M>', mid) END) AS output_sha256,
            sha256(text) AS restored_sha256 FROM p""",
}
