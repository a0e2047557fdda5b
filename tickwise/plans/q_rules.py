"""Checked queries for association rules (ML-19 … ML-22, TK-02/03, ST-02/04, AG-22)."""
from __future__ import annotations

from pyspark.sql import functions as F

from tickwise.functions.exprs import present
from tickwise.operators import rules as RU
from tickwise.plans.catalog import register
from tickwise.plans.q_timeseries import features
from tickwise.plans.sqlparts import R, features_sql

MIN_SUPPORT, MIN_CONF, MAX_RULES = 0.05, 0.5, 200


def rules_sql(key: str = "l_suppkey", min_support=MIN_SUPPORT, min_conf=MIN_CONF) -> str:
    return f"""
    WITH f AS ({features_sql(key)}),
    b AS (SELECT ticker, date, list_sort(list_filter([
            CASE WHEN coalesce(Close / lag(Close) OVER w - 1, 0.0) > 0 THEN 'RET_UP' END,
            CASE WHEN coalesce(Close / lag(Close) OVER w - 1, 0.0) < 0 THEN 'RET_DOWN' END,
            CASE WHEN Close > (CASE WHEN count(Close) OVER w10 >= 5 THEN avg(Close) OVER w10 END)
                 THEN 'PRICE_ABOVE_SMA10' END,
            CASE WHEN Volume >= quantile_cont(Volume, 0.8) OVER (PARTITION BY ticker) THEN 'VOL_HIGH' END],
            lambda x: x IS NOT NULL)) AS items
          FROM f WINDOW w AS (PARTITION BY ticker ORDER BY date),
                        w10 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
    n AS (SELECT ticker, count(*) AS n FROM b GROUP BY ticker),
    s AS (SELECT ticker, unnest(list_transform(range(1, (1 << len(items))),
              lambda m: list_filter(items, lambda x, i: ((m >> (i - 1)) & 1) = 1))) AS itemset FROM b),
    freq AS (SELECT s.ticker, itemset, array_to_string(itemset, ',') AS key, count(*) AS count,
                    count(*) / max(n.n) AS support
             FROM s JOIN n USING (ticker) GROUP BY s.ticker, itemset HAVING count(*) / max(n.n) >= {min_support}),
    sp AS (SELECT ticker, itemset, support AS s_ac, unnest(range(1, (1 << len(itemset)) - 1)) AS m
           FROM freq WHERE len(itemset) >= 2),
    r AS (SELECT ticker, s_ac, list_filter(itemset, lambda x, i: ((m >> (i - 1)) & 1) = 1) AS a,
                 list_filter(itemset, lambda x, i: ((m >> (i - 1)) & 1) = 0) AS c FROM sp),
    j AS (SELECT r.ticker, a, c, s_ac AS support, s_ac / fa.support AS confidence, fa.support AS s_a, fc.support AS s_c
          FROM r JOIN freq fa ON fa.ticker = r.ticker AND fa.key = array_to_string(a, ',')
                 JOIN freq fc ON fc.ticker = r.ticker AND fc.key = array_to_string(c, ',')),
    rules AS (SELECT ticker, a, c, support, confidence, confidence / s_c AS lift, support - s_a * s_c AS leverage,
                     CASE WHEN confidence >= 1.0 THEN CAST('inf' AS DOUBLE) ELSE (1 - s_c) / (1 - confidence) END AS conviction
              FROM j WHERE confidence >= {min_conf}),
    d AS (SELECT * FROM rules QUALIFY row_number() OVER (PARTITION BY ticker, list_sort(list_concat(a, c))
            ORDER BY confidence DESC, lift DESC, support DESC, array_to_string(a, ','), array_to_string(c, ',')) = 1),
    top AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY confidence DESC, lift DESC, support DESC,
                     array_to_string(a, ','), array_to_string(c, ',')) AS rank FROM d)"""


RULES_SQL = rules_sql()
_METRICS_SQL = ", ".join(R(c, c) for c in ("support", "confidence", "lift", "leverage", "conviction"))


def _rules_out(df):
    return present(df.select("ticker", F.array_join("antecedents", ",").alias("antecedents"),
                             F.array_join("consequents", ",").alias("consequents"),
                             *[c for c in ("rank",) if c in df.columns],
                             "support", "confidence", "lift", "leverage", "conviction"))


def _baskets(spark, sf):
    return RU.build_baskets(features(spark, sf, "l_suppkey"))


@register("item_baskets", "ML-19", f"""{RULES_SQL}
    SELECT ticker, date, array_to_string(items, ',') AS items, CAST(len(items) AS BIGINT) AS n_items FROM b""")
def q_baskets(spark, sf):
    b = _baskets(spark, sf)
    return b.select("ticker", "date", F.array_join("items", ",").alias("items"),
                    F.size("items").cast("bigint").alias("n_items"))


@register("frequent_itemsets", "ML-20", f"""{RULES_SQL}
    SELECT ticker, key, count, {R('support', 'support')} FROM freq""")
def q_itemsets(spark, sf):
    return present(RU.frequent_itemsets(_baskets(spark, sf), MIN_SUPPORT).drop("itemset"))


@register("association_rules_all", "ML-21", f"""{RULES_SQL}
    SELECT ticker, array_to_string(a, ',') AS antecedents, array_to_string(c, ',') AS consequents, {_METRICS_SQL}
    FROM rules""")
def q_rules_all(spark, sf):
    return _rules_out(RU.all_rules(RU.frequent_itemsets(_baskets(spark, sf), MIN_SUPPORT), MIN_CONF))


@register("association_rules", "ML-22, TK-02, TK-03, ST-02", f"""{RULES_SQL}
    SELECT ticker, array_to_string(a, ',') AS antecedents, array_to_string(c, ',') AS consequents,
           rank, {_METRICS_SQL} FROM top WHERE rank <= {MAX_RULES}""")
def q_rules(spark, sf):
    return _rules_out(RU.mine_rules(features(spark, sf, "l_suppkey"), MIN_SUPPORT, MIN_CONF, MAX_RULES))


@register("rules_with_items", "ST-04", f"""{RULES_SQL}
    SELECT ticker, array_to_string(a, ',') AS antecedents, array_to_string(c, ',') AS consequents,
           rank, {_METRICS_SQL} FROM top
    WHERE rank <= {MAX_RULES} AND list_contains(list_concat(a, c), 'RET_DOWN')
      AND list_contains(list_concat(a, c), 'VOL_HIGH')""")
def q_rules_items(spark, sf):
    r = RU.mine_rules(features(spark, sf, "l_suppkey"), MIN_SUPPORT, MIN_CONF, MAX_RULES)
    return _rules_out(RU.rules_with_items(r, "RET_DOWN", "VOL_HIGH"))


@register("rule_item_cooccurrence", "AG-22", f"""{RULES_SQL}
    SELECT ticker, a, b, count(*) AS n_rules FROM (
      SELECT ticker, x AS a, unnest(list_filter(it, lambda y: y <> x)) AS b
      FROM (SELECT ticker, it, unnest(it) AS x FROM (
              SELECT ticker, list_distinct(list_concat(a, c)) AS it FROM top WHERE rank <= {MAX_RULES})))
    GROUP BY ALL""")
def q_cooccurrence(spark, sf):
    r = RU.mine_rules(features(spark, sf, "l_suppkey"), MIN_SUPPORT, MIN_CONF, MAX_RULES)
    return RU.item_cooccurrence(r)
