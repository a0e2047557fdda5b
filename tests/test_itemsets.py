"""Frequent itemsets by vertical bitmaps against brute force, and the plan's shape."""
import itertools
import random

from pyspark.sql import functions as F

from tickwise.operators import rules as R


def slow(rows, min_support):
    out = {}
    for ticker in {t for t, _ in rows}:
        baskets = [set(b) for t, b in rows if t == ticker]
        items = sorted({x for b in baskets for x in b})
        for k in range(1, len(items) + 1):
            for c in itertools.combinations(items, k):
                n = sum(set(c) <= b for b in baskets)
                if n and n / len(baskets) >= min_support:
                    out[ticker, c] = (n, n / len(baskets))
    return out


def mined(spark, rows, min_support, **kw):
    df = spark.createDataFrame(rows, "ticker string, items array<string>")
    return {(r.ticker, tuple(r.itemset)): (r["count"], r.support) for r in R.frequent_itemsets(df, min_support, **kw).collect()}


def test_itemsets_match_brute_force(spark, monkeypatch):
    r = random.Random(7)
    names = ["a", "b,c", "b", "c", "d=1", "", "ü"]
    rows = [("T1", [x for x in names if r.random() < 0.5]) for _ in range(300)] + [("T2", [x for x in names[:4] if r.random() < 0.8]) for _ in range(70)]
    rows += [("T1", ["a", "a", "b"])] * 1000 + [("T3", [])] * 5 + [("T4", ["d=1"])] + [("T1", [])] * 13
    want = slow(rows, 0.03)
    assert mined(spark, rows, 0.03) == want and len(want) > 50
    # the numbering in salts has no part in the result
    monkeypatch.setattr(R, "SALT_ROWS", 8)
    assert mined(spark, rows, 0.03) == want


def test_a_count_is_kept_in_planes(spark):
    df = spark.createDataFrame([("T", ["a", "b"])] * 13 + [("T", ["a"])] * 70, "ticker string, items array<string>")
    counted = df.groupBy("ticker", F.col("items").alias("_it")).agg(F.count(F.lit(1)).alias("_c"))
    sizes = counted.groupBy("ticker").agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_m"))
    rows = R.basket_words(counted, sizes, ["ticker"]).collect()
    total = lambda x: sum(bin(r._w % 2**64).count("1") << r._p for r in rows if r._x == x)
    assert total("a") == 83 and total("b") == 13 and len([r for r in rows if r._x == "b"]) == 3


def test_many_distinct_baskets_take_few_words(spark):
    """Rows of the bitmaps are counted in blocks of 64 baskets, not in baskets."""
    rows = [("T", [f"i{j}" for j in range(12) if n >> j & 1]) for n in range(4096)]
    df = spark.createDataFrame(rows, "ticker string, items array<string>")
    counted = df.groupBy("ticker", F.col("items").alias("_it")).agg(F.count(F.lit(1)).alias("_c"))
    sizes = counted.groupBy("ticker").agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_m"))
    words = R.basket_words(counted, sizes, ["ticker"])
    assert words.count() <= 12 * 64 and words.agg(F.sum(F.bit_count("_w"))).first()[0] == 12 * 2048
    assert mined(spark, rows, 0.2) == slow([("T", b) for _, b in rows], 0.2)


def test_no_rows_and_no_group(spark):
    assert mined(spark, [], 0.1) == {}
    assert mined(spark, [("T", [])] * 3, 0.1) == {}
