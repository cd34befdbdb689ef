"""Every registered query against its DuckDB statement on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from datapaths import SF001
from rekko.plans.catalog import QUERIES
from rekko.plans.oracle import ORACLE

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return c


def _norm(records, cols):
    def v(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else round(x, 9)
        return x
    return sorted((tuple(v(r[c]) for c in cols) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    pdf = QUERIES[name](spark, SF001).toPandas()
    rel = con.sql(ORACLE[name])
    odf = rel.df()
    assert sorted(pdf.columns) == sorted(odf.columns)
    assert len(pdf) == len(odf)
    cols = sorted(pdf.columns)
    a = pdf[cols].astype(object).where(pdf[cols].notna(), None).to_dict("records")
    b = odf[cols].astype(object).where(odf[cols].notna(), None).to_dict("records")
    assert _norm(a, cols) == _norm(b, cols)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("rule", [
    "SELECT count(*) FROM ({feature_table_unknown}) WHERE user_id > 1000000000 AND user_avg_star = 3.0",
    "SELECT count(*) FROM ({score_pairs_unknown}) WHERE actual_rating IS NULL",
    "SELECT count(*) FROM ({score_pairs_rejects})",
    "SELECT count(*) FROM ({candidates_cold})",
    "SELECT count(*) FROM ({clip}) WHERE prediction = 5.0",
    "SELECT count(*) FROM (SELECT user_id FROM ({part_candidates}) GROUP BY 1 HAVING count(*) >= 20)"])
def test_rules_are_triggered(con, rule):
    """The statements' rows reach the rule they are there for."""
    assert con.sql(rule.format(**ORACLE)).fetchall()[0][0] > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "predicted_rating" in df.columns
