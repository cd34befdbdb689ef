"""DuckDB statements equal to the registered queries (same columns, types).

Written independently of the Spark code, straight from the definitions:
window functions for "last wins" and ranks, a self-join for co-ratings.
"""

from __future__ import annotations

CUTOFF = "TIMESTAMP '2000-01-01 00:00:00'"


def ratings_cte(name: str = "r", item: str = "l_suppkey", split: str = "train") -> str:
    where = {"train": f"WHERE o_orderdate < {CUTOFF}",
             "validation": f"WHERE o_orderdate >= {CUTOFF}",
             "all": ""}[split]
    return f"""{name} AS (
  SELECT o_custkey AS user_id, {item} AS business_id,
         CAST(1 + CAST(floor(l_quantity) AS INTEGER) % 5 AS DOUBLE) AS stars,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  {where})"""


ORD_ASC = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"
ORD_DESC = ("l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, "
            "l_quantity DESC")

# last rating per (user, item), plus the item means over all rows
DEDUP = f"""d AS (
  SELECT user_id, business_id, stars FROM (
    SELECT user_id, business_id, stars,
           row_number() OVER (PARTITION BY user_id, business_id ORDER BY {ORD_DESC}) AS rn
    FROM r) WHERE rn = 1)"""


def sums_cte(min_raters: int) -> str:
    # centred ratings scaled by the item's row count n: x = n*stars - Σstars
    return f"""ist AS (
  SELECT business_id, count(*) AS item_rows, sum(stars) AS item_sum,
         count(DISTINCT user_id) AS n_raters
  FROM r GROUP BY business_id),
x AS (
  SELECT d.user_id, d.business_id, ist.item_rows * d.stars - ist.item_sum AS x
  FROM d JOIN ist USING (business_id) WHERE ist.n_raters >= {min_raters}),
sums AS (
  SELECT a.business_id AS a, b.business_id AS b,
         sum(a.x * b.x) AS sxy, sum(a.x * a.x) AS sxx, sum(b.x * b.x) AS syy,
         CAST(count(*) AS BIGINT) AS n
  FROM x a JOIN x b ON a.user_id = b.user_id AND a.business_id < b.business_id
  GROUP BY 1, 2)"""


SIM_CTE = """pairs AS (
  SELECT a, b, sxy / (sqrt(sxx) * sqrt(syy)) AS c, n FROM sums
  WHERE n >= 20 AND sqrt(sxx) * sqrt(syy) <> 0),
sim AS (SELECT a, b, c * c AS sim, c AS corr, n AS co_users FROM pairs)"""

TOPK_CTE = """both_ AS (
  SELECT a AS business_id, b AS other_id, sim, corr, co_users FROM sim
  UNION ALL
  SELECT b AS business_id, a AS other_id, sim, corr, co_users FROM sim),
tk AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY business_id ORDER BY sim DESC, other_id) AS rank
    FROM both_) WHERE rank <= 50)"""


def candidates_sql(max_pool: int, item: str = "l_suppkey", min_co: int = 20, cold: bool = True) -> str:
    sims = SIM_CTE.replace("n >= 20", f"n >= {min_co}")
    # the top-k table is read several times, so it is computed once.  The rows are
    # ordered because DuckDB does not end when a LIMIT is put on top of these tables unordered
    topk = TOPK_CTE.replace("tk AS (", "tk AS MATERIALIZED (")
    with_cold = """
SELECT * FROM warm WHERE user_id IN (SELECT c_custkey FROM customer)
UNION ALL SELECT * FROM cold ORDER BY ALL""" if cold else "SELECT user_id, business_id FROM warm ORDER BY ALL"
    return f"""WITH {ratings_cte(item=item)}, {DEDUP}, {sums_cte(min_co)}, {sims}, {topk},
seeds AS MATERIALIZED (
  SELECT user_id, business_id AS seed, min(pos) AS seed_pos FROM (
    SELECT user_id, business_id,
           row_number() OVER (PARTITION BY user_id ORDER BY {ORD_ASC}) AS pos
    FROM r) GROUP BY 1, 2),
expd AS (
  SELECT s.user_id, t.other_id AS business_id, s.seed_pos
  FROM seeds s JOIN tk t ON t.business_id = s.seed AND t.rank <= 20),
fresh AS (
  SELECT e.* FROM expd e ANTI JOIN seeds s2 ON s2.user_id = e.user_id AND s2.seed = e.business_id),
firsts AS MATERIALIZED (SELECT user_id, business_id, min(seed_pos) AS first_pos FROM fresh GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY first_pos, business_id) AS rn
  FROM firsts),
cut AS (
  SELECT user_id, count(*) FILTER (WHERE rn <= {max_pool}) AS n_head,
         max(first_pos) FILTER (WHERE rn <= {max_pool}) AS last_pos
  FROM ranked GROUP BY user_id),
warm AS (
  SELECT f.user_id, f.business_id, false AS is_cold
  FROM firsts f JOIN cut c USING (user_id)
  WHERE c.n_head < {max_pool} OR f.first_pos <= c.last_pos),
pool AS (
  SELECT business_id FROM (SELECT business_id, avg(stars) AS m FROM r GROUP BY 1)
  ORDER BY m DESC, business_id LIMIT {max_pool}),
cold AS (
  SELECT c.c_custkey AS user_id, p.business_id, true AS is_cold
  FROM (SELECT c_custkey FROM customer ANTI JOIN r ON c_custkey = user_id) c, pool p)
{with_cold}"""


ORACLE: dict[str, str] = {
    "top_items_by_mean": f"""WITH {ratings_cte(item='l_partkey')},
m AS (SELECT business_id, avg(stars) AS avg_rating, count(*) AS n_ratings FROM r GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY avg_rating DESC, business_id) AS pool_rank
FROM m ORDER BY avg_rating DESC, business_id LIMIT 300""",

    "user_mean": f"""WITH {ratings_cte()}
SELECT user_id, avg(stars) AS avg_rating, count(*) AS n_ratings FROM r GROUP BY 1""",

    "item_mean": f"""WITH {ratings_cte()}
SELECT business_id, avg(stars) AS avg_rating, count(*) AS n_ratings FROM r GROUP BY 1""",

    "global_mean": f"""WITH {ratings_cte()}
SELECT coalesce(avg(stars), 0.0) AS avg_rating, count(*) AS n_ratings FROM r""",

    "rating_dedup_last": f"""WITH {ratings_cte()}
SELECT user_id, business_id, stars, n_rows FROM (
  SELECT user_id, business_id, stars,
         row_number() OVER (PARTITION BY user_id, business_id ORDER BY {ORD_DESC}) AS rn,
         count(*) OVER (PARTITION BY user_id, business_id) AS n_rows
  FROM r) WHERE rn = 1""",

    "user_items": f"""WITH {ratings_cte()}
SELECT r.user_id, r.business_id, coalesce(s.s_name, 'N/A') AS business_name
FROM r LEFT JOIN supplier s ON s.s_suppkey = r.business_id""",

    "item_users": f"""WITH {ratings_cte()}
SELECT r.business_id, r.user_id, coalesce(c.c_name, 'N/A') AS user_name
FROM r LEFT JOIN customer c ON c.c_custkey = r.user_id""",

    "photo_count": """SELECT p.p_partkey AS business_id, CAST(count(e.user_id) AS BIGINT) AS photo_count
FROM part p LEFT JOIN events e ON e.user_id = p.p_partkey GROUP BY 1""",

    "top_raters": f"""WITH {ratings_cte()},
t AS (SELECT user_id, count(*) AS rating_count FROM r GROUP BY 1
      ORDER BY rating_count DESC, user_id LIMIT 5)
SELECT t.user_id, t.rating_count, c.c_name AS name
FROM t LEFT JOIN customer c ON c.c_custkey = t.user_id""",

    "top_rated": f"""WITH {ratings_cte()},
t AS (SELECT business_id, count(*) AS rating_count FROM r GROUP BY 1
      ORDER BY rating_count DESC, business_id LIMIT 5)
SELECT t.business_id, t.rating_count, s.s_name AS name
FROM t LEFT JOIN supplier s ON s.s_suppkey = t.business_id""",

    "first_item_sample": f"""WITH {ratings_cte(split='validation')},
f AS (SELECT * FROM r ORDER BY {ORD_ASC} LIMIT 100)
SELECT user_id, arg_min(business_id, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity)) AS business_id
FROM f GROUP BY user_id""",

    "co_rating_sums": f"""WITH {ratings_cte()}, {DEDUP}, {sums_cte(1)},
u AS (
  SELECT a, b, sxy / (na.item_rows * nb.item_rows) AS sxy,
         sxx / (na.item_rows * na.item_rows) AS sxx, syy / (nb.item_rows * nb.item_rows) AS syy, n
  FROM sums JOIN ist na ON na.business_id = a JOIN ist nb ON nb.business_id = b)
SELECT a AS business_id, b AS other_id, sxy, sxx, syy, n AS co_users FROM u""",

    "item_similarity": f"""WITH {ratings_cte()}, {DEDUP}, {sums_cte(20)}, {SIM_CTE}
SELECT a AS business_id, b AS other_id, sim, corr, co_users FROM sim""",

    "item_topk": f"""WITH {ratings_cte()}, {DEDUP}, {sums_cte(20)}, {SIM_CTE}, {TOPK_CTE}
SELECT business_id, other_id, sim, corr, co_users, rank FROM tk""",

    "candidates": candidates_sql(300),
    "candidates_capped": candidates_sql(15),
}


# ------------------------------------------------------- sources and features

def business_cte(name: str, source: str, k: str, s: str, bname: str, city: str,
                 state: str) -> str:
    """Parsed business features computed straight from the key columns
    (see rekko.sources.synth for the rules the JSON was generated by)."""
    att = f"({k}) % 7 >= 2"
    return f"""{name} AS (
  SELECT {k} AS business_id, {bname} AS name,
         CASE WHEN ({k}) % 11 = 0 THEN 'N/A' ELSE {city} END AS city, {state} AS state,
         1.0::DOUBLE + (({s}) % 9) * 0.5::DOUBLE AS bus_stars,
         CAST((({k}) % 50) * 3 + {s} AS DOUBLE) AS review_count_bus,
         CAST((({k}) + {s}) % 2 AS INTEGER) AS is_open,
         CAST(CASE ({k}) % 8 WHEN 3 THEN 0 WHEN 4 THEN 0 WHEN 5 THEN 2 WHEN 6 THEN 5 ELSE 7 END
              AS INTEGER) AS operation_days,
         CASE WHEN NOT ({att}) THEN 2.0::DOUBLE
              ELSE CAST(CASE ({s}) % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3
                                     WHEN 5 THEN 4 ELSE 2 END AS DOUBLE) END AS price_range,
         CAST(CASE WHEN {att} AND ({s}) % 4 IN (0, 2) THEN 1 ELSE 0 END AS INTEGER) AS credit_card,
         CASE WHEN {att} AND ({k}) % 5 = 0 THEN 'False'
              WHEN {att} AND ({k}) % 5 = 1 THEN 'True' END AS validated,
         CASE WHEN {att} THEN CASE ({k}) % 4 WHEN 0 THEN 'u''quiet''' WHEN 1 THEN 'u''average'''
                                          WHEN 2 THEN 'u''loud''' END END AS noise_level,
         CASE WHEN {att} THEN CASE ({s}) % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False'
                                          ELSE 'None' END END AS delivery,
         CASE WHEN {att} THEN CASE ({k}) % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' END END
              AS takeout,
         CASE WHEN {att} THEN CASE (({k}) + {s}) % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' END END
              AS wifi,
         CASE WHEN {att} AND ({s}) % 2 = 0 THEN 'True' END AS table_service,
         CASE WHEN {att} THEN CASE ({k}) % 2 WHEN 0 THEN 'True' ELSE 'False' END END
              AS wheelchair_accessible,
         (SELECT CAST(count(*) AS BIGINT) FROM events e WHERE e.user_id = {k}) AS photo_count
  FROM {source})"""


SUPPLIER_BUSINESS = business_cte(
    "biz", "supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "s_suppkey", "s_nationkey", "s_name", "n_name", "r_name")
PART_BUSINESS = business_cte("biz", "part", "p_partkey", "p_size", "p_name", "p_brand", "p_type")

USERS = """usr AS (
  SELECT c_custkey AS user_id,
         CASE WHEN c_custkey % 13 = 0 THEN 'N/A' ELSE c_name END AS name,
         CASE WHEN c_nationkey % 6 = 0 THEN 3.0::DOUBLE
              ELSE 1.0::DOUBLE + CAST((c_custkey * 7) % 41 AS DOUBLE) / 10.0::DOUBLE END AS user_avg_star,
         CASE WHEN c_custkey % 5 = 0 THEN 0.0::DOUBLE ELSE CAST(c_custkey % 97 AS DOUBLE) END
              AS user_review_cnt,
         CASE WHEN c_custkey % 5 = 1 THEN 0.0::DOUBLE
              ELSE CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) % 100 AS DOUBLE) END AS user_useful,
         CAST(c_nationkey AS DOUBLE) AS user_funny,
         CASE WHEN c_custkey % 3 = 0 THEN 0.0::DOUBLE ELSE CAST(length(c_mktsegment) AS DOUBLE) END
              AS user_cool
  FROM customer)"""

BUSINESS_FEATURE_LIST = ("bus_stars, review_count_bus, photo_count, operation_days, price_range, "
                         "credit_card, is_open, validated, noise_level, delivery, takeout, wifi, "
                         "table_service, wheelchair_accessible")


def features_cte(name: str, split: str) -> str:
    return f"""{ratings_cte('fr_' + name, split=split)},
{name} AS (
  SELECT r.user_id, r.business_id, r.stars AS label,
         u.user_avg_star, u.user_review_cnt, u.user_useful, u.user_funny, u.user_cool,
         {', '.join('b.' + c for c in BUSINESS_FEATURE_LIST.split(', '))},
         u.user_avg_star - b.bus_stars AS user_bus_rating_diff,
         u.user_avg_star / (b.bus_stars + 0.1::DOUBLE) AS user_bus_rating_ratio,
         u.user_review_cnt / (u.user_useful + 1) AS user_activity_ratio
  FROM fr_{name} r LEFT JOIN usr u USING (user_id) LEFT JOIN biz b USING (business_id))"""


CATS = ["credit_card", "is_open", "validated", "noise_level", "delivery", "takeout", "wifi",
        "table_service", "wheelchair_accessible"]
NUMERIC_LEVEL = {"credit_card", "is_open"}
N_NUMERIC = 13


def _levels_cte() -> str:
    parts = []
    for i, c in enumerate(CATS):
        sk = f"CAST({c} AS DOUBLE)" if c in NUMERIC_LEVEL else "NULL::DOUBLE"
        parts.append(f"SELECT DISTINCT {i} AS cpos, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS level, "
                     f"{sk} AS sk FROM ft WHERE {c} IS NOT NULL")
    return f"""lv AS ({' UNION ALL '.join(parts)}),
kept AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY cpos ORDER BY sk, level) AS rn FROM lv)
  WHERE rn > 1),
levels AS (
  SELECT "column", level, cpos,
         CAST({N_NUMERIC} - 1 + row_number() OVER (ORDER BY cpos, sk, level) AS BIGINT) AS position,
         "column" || '_' || level AS feature
  FROM kept)"""


def _onehot_fitted() -> str:
    arms = " UNION ALL ".join(
        f"SELECT v.user_id, v.business_id, l.feature FROM fv v JOIN levels l "
        f"ON l.cpos = {i} AND CAST(v.{c} AS VARCHAR) = l.level" for i, c in enumerate(CATS))
    return f"""WITH {USERS}, {SUPPLIER_BUSINESS}, {features_cte('ft', 'train')},
{features_cte('fv', 'validation')}, {_levels_cte()}
{arms}"""


# ------------------------------------------------------ scoring and reports

BIAS = f"""{ratings_cte('r', split='train')}, {ratings_cte('v', split='validation')},
g AS (SELECT avg(stars) AS g FROM r),
um AS (SELECT user_id, avg(stars) AS um FROM r GROUP BY 1),
im AS (SELECT business_id, avg(stars) AS im FROM r GROUP BY 1),
raw AS (
  SELECT v.*, g.g + coalesce(um.um - g.g, 0.0::DOUBLE) + coalesce(im.im - g.g, 0.0::DOUBLE) AS raw_pred
  FROM v CROSS JOIN g LEFT JOIN um USING (user_id) LEFT JOIN im USING (business_id)),
res AS (
  SELECT raw.user_id, raw.business_id, least(raw_pred, 5.0::DOUBLE) AS pred_rating,
         raw.stars AS true_rating, c.c_name AS user_name, s.s_name AS business_name,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
  FROM raw LEFT JOIN customer c ON c.c_custkey = raw.user_id
  LEFT JOIN supplier s ON s.s_suppkey = raw.business_id)"""

INTERVALS = [(1.0, 2.0), (2.0, 3.0), (3.0, 4.0), (4.0, 5.0), (4.9, 5.1)]
IV_VALUES = ", ".join(f"({i}, {lo}::DOUBLE, {hi}::DOUBLE, '{lo}-{hi}')"
                      for i, (lo, hi) in enumerate(INTERVALS))

RECOMMEND = f"""WITH {ratings_cte()}, {DEDUP}, {sums_cte(20)}, {SIM_CTE}, {TOPK_CTE},
seeds AS (
  SELECT user_id, business_id AS seed, min(pos) AS seed_pos FROM (
    SELECT user_id, business_id,
           row_number() OVER (PARTITION BY user_id ORDER BY {ORD_ASC}) AS pos
    FROM r) GROUP BY 1, 2),
expd AS (
  SELECT s.user_id, t.other_id AS business_id, s.seed_pos
  FROM seeds s JOIN tk t ON t.business_id = s.seed AND t.rank <= 20),
fresh AS (
  SELECT e.* FROM expd e ANTI JOIN seeds s2 ON s2.user_id = e.user_id AND s2.seed = e.business_id),
firsts AS MATERIALIZED (SELECT user_id, business_id, min(seed_pos) AS first_pos FROM fresh GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY first_pos, business_id) AS rn
  FROM firsts),
cut AS (
  SELECT user_id, count(*) FILTER (WHERE rn <= 300) AS n_head,
         max(first_pos) FILTER (WHERE rn <= 300) AS last_pos
  FROM ranked GROUP BY user_id),
warm AS (
  SELECT f.user_id, f.business_id FROM firsts f JOIN cut c USING (user_id)
  WHERE c.n_head < 300 OR f.first_pos <= c.last_pos),
pool AS (
  SELECT business_id FROM (SELECT business_id, avg(stars) AS m FROM r GROUP BY 1)
  ORDER BY m DESC, business_id LIMIT 300),
cold AS (
  SELECT c.c_custkey AS user_id, p.business_id FROM customer c, pool p
  WHERE c.c_custkey NOT IN (SELECT user_id FROM r)),
cands AS (SELECT * FROM warm WHERE user_id IN (SELECT c_custkey FROM customer)
          UNION ALL SELECT * FROM cold),
g AS (SELECT avg(stars) AS g FROM r),
um AS (SELECT user_id, avg(stars) AS um FROM r GROUP BY 1),
im AS (SELECT business_id, avg(stars) AS im FROM r GROUP BY 1),
scored AS (
  SELECT cands.user_id, cands.business_id,
         g.g + coalesce(um.um - g.g, 0.0::DOUBLE) + coalesce(im.im - g.g, 0.0::DOUBLE) AS p
  FROM cands CROSS JOIN g LEFT JOIN um USING (user_id) LEFT JOIN im USING (business_id)),
top AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY p DESC, business_id) AS rank
    FROM scored) WHERE rank <= 10)
SELECT t.user_id, coalesce(c.c_name, 'N/A') AS user_name, t.business_id,
       coalesce(s.s_name, 'N/A') AS business_name, coalesce(n.n_name, 'N/A') AS city,
       coalesce(rg.r_name, 'N/A') AS state, t.p AS predicted_rating, t.rank
FROM top t LEFT JOIN customer c ON c.c_custkey = t.user_id
LEFT JOIN supplier s ON s.s_suppkey = t.business_id
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
LEFT JOIN region rg ON rg.r_regionkey = n.n_regionkey"""

TARGET_ON_REFERENCE = f"""WITH {ratings_cte()}, {DEDUP},
g AS (SELECT avg(stars) AS g FROM r),
um AS (SELECT user_id, avg(stars) AS um FROM r GROUP BY 1),
im AS (SELECT business_id, avg(stars) AS im FROM r GROUP BY 1),
req AS (SELECT a.c_custkey AS target_id, b.c_custkey AS reference_id
        FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1),
rows_ AS (SELECT req.target_id, req.reference_id, r.business_id
          FROM req JOIN r ON r.user_id = req.reference_id)
SELECT x.target_id, x.reference_id, x.business_id, coalesce(s.s_name, 'N/A') AS business_name,
       g.g + coalesce(um.um - g.g, 0.0::DOUBLE) + coalesce(im.im - g.g, 0.0::DOUBLE)
         AS predicted_for_target,
       dr.stars AS ref_user_true, dt.stars AS target_true
FROM rows_ x CROSS JOIN g
LEFT JOIN um ON um.user_id = x.target_id
LEFT JOIN im ON im.business_id = x.business_id
LEFT JOIN d dr ON dr.user_id = x.reference_id AND dr.business_id = x.business_id
LEFT JOIN d dt ON dt.user_id = x.target_id AND dt.business_id = x.business_id
LEFT JOIN supplier s ON s.s_suppkey = x.business_id"""

ORACLE.update({
    "business_features": f"""WITH {PART_BUSINESS}
SELECT business_id, name, city, state, {BUSINESS_FEATURE_LIST} FROM biz""",

    "user_features": f"""WITH {USERS} SELECT * FROM usr""",

    "feature_table": f"""WITH {USERS}, {SUPPLIER_BUSINESS}, {features_cte('ft', 'train')}
SELECT * FROM ft""",

    "onehot_levels": f"""WITH {USERS}, {SUPPLIER_BUSINESS}, {features_cte('ft', 'train')},
{_levels_cte()}
SELECT "column", level, position, feature FROM levels""",

    "onehot_fitted": _onehot_fitted(),

    "batch_predictions": f"""WITH {BIAS}
SELECT user_id, business_id, pred_rating AS prediction FROM res""",

    "rmse": f"""WITH {BIAS}
SELECT round(sqrt(avg((pred_rating - true_rating) * (pred_rating - true_rating))), 9) AS rmse,
       count(*) AS n FROM res""",

    "error_histogram": f"""WITH {BIAS},
e AS (SELECT abs(pred_rating - true_rating) AS err FROM res),
b AS (SELECT * FROM (VALUES (0, '0-1', 0.0::DOUBLE, 1.0::DOUBLE), (1, '1-2', 1.0, 2.0),
                            (2, '2-3', 2.0, 3.0), (3, '3-4', 3.0, 4.0),
                            (4, '4+', 4.0, NULL)) t(i, bucket, lo, hi))
SELECT b.bucket, CAST(count(e.err) AS BIGINT) AS count,
       count(e.err) / (SELECT count(*) FROM e) * 100.0::DOUBLE AS percent
FROM b LEFT JOIN e ON e.err >= b.lo AND (b.hi IS NULL OR e.err < b.hi)
GROUP BY b.i, b.bucket""",

    "high_error": f"""WITH {BIAS}
SELECT user_id, business_id, pred_rating AS predicted, true_rating AS actual,
       abs(pred_rating - true_rating) AS error
FROM res WHERE abs(pred_rating - true_rating) >= 3.0""",

    "top_predicted": f"""WITH {BIAS}
SELECT user_id, business_id, pred_rating, true_rating, user_name, business_name
FROM res ORDER BY pred_rating DESC, user_id, business_id LIMIT 10""",

    "low_error_sample": f"""WITH {BIAS},
iv AS (SELECT * FROM (VALUES {IV_VALUES}) t(pos, lo, hi, interval)),
hit AS (
  SELECT res.*, abs(pred_rating - true_rating) AS error, iv.pos, iv.interval
  FROM res JOIN iv ON pred_rating >= iv.lo AND pred_rating < iv.hi
  WHERE abs(pred_rating - true_rating) < 0.1),
rk AS (
  SELECT *, row_number() OVER (PARTITION BY pos ORDER BY error, {ORD_ASC}) AS rn FROM hit)
SELECT user_id, business_id, pred_rating, true_rating, user_name, business_name, error, interval,
       CAST(pos AS BIGINT) AS interval_pos, rn AS rank_in_interval
FROM rk WHERE rn <= 3""",

    "score_pairs": f"""WITH {BIAS},
last AS (
  SELECT user_id, business_id, stars AS actual_rating FROM (
    SELECT user_id, business_id, stars,
           row_number() OVER (PARTITION BY user_id, business_id ORDER BY {ORD_DESC}) AS rn
    FROM v) WHERE rn = 1)
SELECT raw.user_id, coalesce(c.c_name, 'N/A') AS user_name, raw.business_id,
       coalesce(s.s_name, 'N/A') AS business_name, raw.raw_pred AS predicted_rating,
       last.actual_rating
FROM raw LEFT JOIN customer c ON c.c_custkey = raw.user_id
LEFT JOIN supplier s ON s.s_suppkey = raw.business_id
LEFT JOIN last USING (user_id, business_id)""",

    "sample_items": f"""WITH {ratings_cte(split='validation')},
f AS (SELECT * FROM r ORDER BY {ORD_ASC} LIMIT 100)
SELECT DISTINCT arg_min(business_id, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity)) AS business_id
FROM f GROUP BY user_id""",

    "item_rating_map": f"""WITH {ratings_cte()}
SELECT business_id, user_id, stars FROM (
  SELECT user_id, business_id, stars,
         row_number() OVER (PARTITION BY user_id, business_id ORDER BY {ORD_DESC}) AS rn
  FROM r) WHERE rn = 1""",

    "cold_start_pool": f"""WITH {ratings_cte()},
m AS (SELECT business_id, avg(stars) AS avg_rating, count(*) AS n_ratings FROM r GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY avg_rating DESC, business_id) AS pool_rank
FROM m ORDER BY avg_rating DESC, business_id LIMIT 300""",

    "recommend": RECOMMEND,
    "target_on_reference": TARGET_ON_REFERENCE,
})


# --------------------------------------------- model rows and untriggered rules

UNKNOWN = f"""un AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN user_id + 1000000000 ELSE user_id END AS user_id,
         CASE WHEN business_id % 5 = 0 THEN business_id + 1000000000 ELSE business_id END AS business_id,
         stars
  FROM src)"""

# values of an unknown user or business
MISS = {"user_avg_star": "3.0::DOUBLE", "user_review_cnt": "0.0::DOUBLE", "user_useful": "0.0::DOUBLE",
        "user_funny": "0.0::DOUBLE", "user_cool": "0.0::DOUBLE", "bus_stars": "3.5::DOUBLE",
        "review_count_bus": "0.0::DOUBLE", "photo_count": "0::BIGINT", "operation_days": "7::INTEGER",
        "price_range": "2.0::DOUBLE", "credit_card": "1::INTEGER", "is_open": "1::INTEGER"}


def _missed(column: str) -> str:
    side = "u" if column.startswith("user_") else "b"
    key = "user_id" if side == "u" else "business_id"
    return f"CASE WHEN {side}.{key} IS NULL THEN {MISS.get(column, 'NULL')} ELSE {side}.{column} END AS {column}"


_BASE = ["user_avg_star", "user_review_cnt", "user_useful", "user_funny", "user_cool",
         *BUSINESS_FEATURE_LIST.split(", ")]

ORACLE.update({
    "feature_table_hot": f"""WITH {USERS}, {SUPPLIER_BUSINESS}, {features_cte('ft', 'train').replace(
        "FROM fr_ft r", "FROM (SELECT * REPLACE (CASE WHEN user_id % 5 < 2 THEN 1 ELSE business_id END AS business_id)"
        " FROM fr_ft) r")}
SELECT * FROM ft""",

    "ratings_csv": f"""WITH {ratings_cte()}
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(business_id AS VARCHAR) AS business_id,
  CASE WHEN business_id % 13 <> 0 THEN stars END AS stars FROM r""",

    "ratings_csv_headerless": f"""WITH {ratings_cte()}
SELECT CASE WHEN user_id % 4 = 2 THEN concat(user_id, ' ') ELSE CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN user_id % 4 = 2 THEN concat(' ', business_id) ELSE CAST(business_id AS VARCHAR) END AS business_id,
  CASE WHEN business_id % 13 <> 0 THEN stars END AS stars FROM r""",

    "truth_csv": f"""WITH {ratings_cte(split='validation')}, {DEDUP}
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(business_id AS VARCHAR) AS business_id,
  CASE WHEN business_id % 13 <> 0 THEN stars END AS stars FROM d""",

    "photo_json": """SELECT user_id AS business_id, count(*) AS photos FROM events GROUP BY 1""",

    "train_predict": f"""WITH {ratings_cte('v', item='l_partkey', split='validation')}
SELECT user_id, business_id, true AS scored, true AS within_cap, true AS beats_mean
FROM v JOIN part ON p_partkey = business_id""",

    "recommend_model": f"""SELECT user_id, least(10, count(*))::BIGINT AS n_items, true AS all_offered,
  true AS ordered FROM ({candidates_sql(300)}) GROUP BY user_id""",

    "feature_table_unknown": f"""WITH {USERS}, {SUPPLIER_BUSINESS}, {ratings_cte('src')}, {UNKNOWN},
base AS (
  SELECT un.user_id, un.business_id, un.stars AS label, {', '.join(map(_missed, _BASE))}
  FROM un LEFT JOIN usr u ON u.user_id = un.user_id LEFT JOIN biz b ON b.business_id = un.business_id)
SELECT *, user_avg_star - bus_stars AS user_bus_rating_diff,
  user_avg_star / (bus_stars + 0.1::DOUBLE) AS user_bus_rating_ratio,
  user_review_cnt / (user_useful + 1) AS user_activity_ratio FROM base""",

    "part_similarity": f"""WITH {ratings_cte(item='l_partkey')}, {DEDUP}, {sums_cte(2)},
{SIM_CTE.replace("n >= 20", "n >= 2")}
SELECT a AS business_id, b AS other_id, sim, corr, co_users FROM sim""",

    "part_candidates": candidates_sql(300, item="l_partkey", min_co=2, cold=False),

    "candidates_cold": f"""WITH {ratings_cte('all_')}, r AS (SELECT * FROM all_ WHERE user_id % 10 <> 0),
pool AS (
  SELECT business_id FROM (SELECT business_id, avg(stars) AS m FROM r GROUP BY 1)
  ORDER BY m DESC, business_id LIMIT 300)
SELECT c.c_custkey AS user_id, p.business_id
FROM (SELECT c_custkey FROM customer ANTI JOIN r ON c_custkey = user_id) c, pool p""",

    "score_pairs_rejects": f"""WITH {ratings_cte('v', split='validation')},
q AS (SELECT CASE WHEN user_id % 7 <> 0 THEN user_id END AS user_id,
             CASE WHEN business_id % 11 <> 0 THEN business_id END AS business_id FROM v)
SELECT user_id, business_id, CASE WHEN user_id IS NULL AND business_id IS NULL THEN 'no user and item id'
  WHEN user_id IS NULL THEN 'no user id' ELSE 'no item id' END AS reason
FROM q WHERE user_id IS NULL OR business_id IS NULL""",

    "score_pairs_unknown": f"""WITH {ratings_cte('src', split='validation')}, {UNKNOWN}, {ratings_cte()},
g AS (SELECT avg(stars) AS g FROM r),
um AS (SELECT user_id, avg(stars) AS um FROM r GROUP BY 1),
im AS (SELECT business_id, avg(stars) AS im FROM r GROUP BY 1),
last AS (
  SELECT user_id, business_id, stars AS actual_rating FROM (
    SELECT user_id, business_id, stars,
           row_number() OVER (PARTITION BY user_id, business_id ORDER BY {ORD_DESC}) AS rn
    FROM src) WHERE rn = 1)
SELECT un.user_id, coalesce(c.c_name, 'N/A') AS user_name, un.business_id,
       coalesce(s.s_name, 'N/A') AS business_name,
       g.g + coalesce(um.um - g.g, 0.0::DOUBLE) + coalesce(im.im - g.g, 0.0::DOUBLE) AS predicted_rating,
       last.actual_rating
FROM un CROSS JOIN g LEFT JOIN um ON um.user_id = un.user_id LEFT JOIN im ON im.business_id = un.business_id
LEFT JOIN customer c ON c.c_custkey = un.user_id LEFT JOIN supplier s ON s.s_suppkey = un.business_id
LEFT JOIN last ON last.user_id = un.user_id AND last.business_id = un.business_id""",

    "onehot_single_row": f"""WITH {USERS}, {SUPPLIER_BUSINESS}, {features_cte('ft', 'train')}, {_levels_cte()},
{ratings_cte('v', split='validation')}
SELECT user_id, business_id, (SELECT count(*) FROM levels) AS dummies, 0::BIGINT AS ones FROM v""",

    "clip": f"""WITH {ratings_cte()}
SELECT user_id, business_id, least(stars * 1.25, 5.0::DOUBLE) AS prediction FROM r""",
})
