"""Association rules per ticker (ML-19 … ML-22, TK-02/03, ST-02/04, AG-22).

Baskets are ``array<string>`` columns.  Equal baskets are counted first and
turned into bitmaps per item; frequent itemsets grow level by level by
intersecting the bitmaps of frequent ones, so no basket is too wide.  Itemsets are compared as arrays, never as joined text.
Rules enumerate every antecedent / consequent split of each frequent itemset
and join the two sides' supports back.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tickwise.operators.quantiles import exact_quantile
from tickwise.operators.timeseries import by_date, full_window
from tickwise.session import materialize

#: Distinct baskets that are numbered in one window.
SALT_ROWS = 4096


def _g(group):
    return [group] if isinstance(group, str) else list(group or [])


def build_baskets(df: DataFrame, part: str = "ticker", order: str = "date",
                  skip=("ticker", "symbol"), max_values: int = 50) -> DataFrame:
    """ML-19: binarise bars into item baskets.

    RET_UP / RET_DOWN from the close-to-close return within this frame (first
    row 0), PRICE_ABOVE_SMA10 against a 10-row mean with 5 minimum rows,
    VOL_HIGH at or above the per-ticker 0.8 quantile of Volume, and
    ``col=value`` for the first ``max_values`` values of each string column.
    """
    w = by_date(part, order)
    c = F.col("Close")
    ret = F.coalesce(F.try_divide(c, F.lag(c).over(w)) - F.lit(1.0), F.lit(0.0))
    sma = full_window(F.avg, c, w, 10, 5)
    cats = [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name.lower() not in skip and f.name != part]
    df = materialize(df.select(*dict.fromkeys([part, order, "Close", "Volume", *cats])))
    high = exact_quantile(df, "Volume", 0.8, [part], "_thr").withColumnRenamed(part, "_part")
    df = df.join(high, F.col(part).eqNullSafe(F.col("_part")), "left").drop("_part")
    flags = [F.when(ret > 0, F.lit("RET_UP")), F.when(ret < 0, F.lit("RET_DOWN")),
             F.when(c > sma, F.lit("PRICE_ABOVE_SMA10")),
             F.when(F.col("Volume") >= F.col("_thr"), F.lit("VOL_HIGH"))]
    out = df
    for cname in cats:
        # first-seen rank of each value within the ticker (AG-24 semantics)
        first = F.min(F.col(order)).over(Window.partitionBy(part, cname))
        out = out.withColumn(f"_first_{cname}", first)
        rk = F.dense_rank().over(Window.partitionBy(part).orderBy(f"_first_{cname}", cname))
        out = out.withColumn(f"_rk_{cname}", F.when(F.col(cname).isNotNull(), rk))
        flags.append(F.when(F.col(f"_rk_{cname}") <= max_values,
                            F.concat(F.lit(f"{cname}="), F.col(cname))))
    return out.select(part, order, F.array_sort(F.array_compact(F.array(*flags))).alias("items"))


def basket_words(counted: DataFrame, sizes: DataFrame, g: list[str]) -> DataFrame:
    """Vertical bitmaps of distinct baskets ``(*g, _it, _c)``: a row per (group, item, plane, block) with a word of 64 baskets.

    A basket that occurs c times has a place in plane p if bit p of c is set, so
    a bit of plane p counts 2^p rows.  Places are numbered inside salts, of which
    a group has more the more distinct baskets it has: no window holds a whole
    hot group.
    """
    salt = F.pmod(F.xxhash64("_it"), F.ceil(F.col("_m") / SALT_ROWS))
    planes = F.expr("filter(sequence(0, 62), p -> shiftright(_c, p) % 2 = 1)")
    placed = counted.join(sizes, g).select(*g, "_it", salt.alias("_s"), F.explode(planes).alias("_p"))
    at = F.row_number().over(Window.partitionBy(*g, "_s", "_p").orderBy("_it")) - 1
    placed = placed.withColumn("_at", at).withColumn("_b", F.floor(F.col("_at") / 64))
    bit = F.expr("shiftleft(1L, cast(_at % 64 as int))")
    return (placed.select(*g, "_s", "_p", "_b", bit.alias("_bit"), F.explode("_it").alias("_x"))
            .groupBy(*g, "_x", "_s", "_p", "_b").agg(F.bit_or("_bit").alias("_w")))


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.05, group=("ticker",),
                      items: str = "items") -> DataFrame:
    """ML-20: itemsets with support ≥ ``min_support``; support counts all
    rows of the group, empty baskets included.

    Vertical: baskets are read once, into one bitmap per item.  Two frequent
    itemsets that differ in their last item make the next one by the bitwise
    and of their words, block by block; its count is the sum of the set bits.
    No level holds the baskets again.
    """
    g = _g(group)
    block = ["_s", "_p", "_b"]
    counted = materialize(baskets.select(*g, F.array_sort(F.array_distinct(items)).alias("_it"))
                          .groupBy(*g, "_it").agg(F.count(F.lit(1)).alias("_c")))
    sizes = counted.groupBy(*g).agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_m"))

    def frequent(words: DataFrame) -> DataFrame:
        cnt = words.groupBy(*g, "_pre", "_x").agg(F.sum(F.expr("shiftleft(cast(bit_count(_w) as bigint), _p)")).alias("count"))
        share = F.col("count") / F.col("_n")
        return materialize(cnt.join(sizes, g).withColumn("support", share).where(F.col("support") >= min_support)
                           .drop("_n", "_m"))

    words = materialize(basket_words(counted, sizes, g).withColumn("_pre", F.array().cast("array<string>")))
    level, found = frequent(words), None
    while found is None or not level.isEmpty():
        found = level if found is None else found.unionByName(level)
        kept = words.join(level.select(*g, "_pre", "_x"), [*g, "_pre", "_x"], "left_semi")
        other = kept.withColumnsRenamed({"_x": "_y", "_w": "_v"})
        both = kept.join(other, [*g, "_pre", *block]).where((F.col("_x") < F.col("_y")) & (F.col("_w").bitwiseAND(F.col("_v")) != 0))
        words = materialize(both.select(*g, F.array_append("_pre", F.col("_x")).alias("_pre"), F.col("_y").alias("_x"), *block,
                                        F.col("_w").bitwiseAND(F.col("_v")).alias("_w")))
        level = frequent(words)
    itemset = F.array_append("_pre", F.col("_x"))
    return found.select(*g, itemset.alias("itemset"), F.array_join(itemset, ",").alias("key"), "count", "support")


def all_rules(freq: DataFrame, min_confidence: float = 0.5, group=("ticker",)) -> DataFrame:
    """ML-21: every antecedent → consequent split of every frequent itemset
    with confidence ≥ ``min_confidence``; lift, leverage, conviction (∞ at
    confidence 1)."""
    g = _g(group)
    big = freq.where(F.size("itemset") >= 2)
    masks = F.expr("sequence(1, shiftleft(1, size(itemset)) - 2)")
    split = big.select(*g, "itemset", F.col("support").alias("s_ac"),
                       F.explode(masks).alias("_m"))
    split = split.select(*g, "itemset", "s_ac",
                         F.expr("filter(itemset, (x, i) -> shiftright(_m, i) % 2 = 1)").alias("antecedents"),
                         F.expr("filter(itemset, (x, i) -> shiftright(_m, i) % 2 = 0)").alias("consequents"))
    sup = freq.select(*g, "itemset", "support")
    j = (split.join(sup.withColumnsRenamed({"itemset": "antecedents", "support": "s_a"}), [*g, "antecedents"])
         .join(sup.withColumnsRenamed({"itemset": "consequents", "support": "s_c"}), [*g, "consequents"]))
    conf = F.col("s_ac") / F.col("s_a")
    j = j.select(*g, "antecedents", "consequents", F.col("s_ac").alias("support"),
                 conf.alias("confidence"), "s_a", "s_c")
    j = j.where(F.col("confidence") >= min_confidence)
    return j.select(*g, "antecedents", "consequents", "support", "confidence",
                    (F.col("confidence") / F.col("s_c")).alias("lift"),
                    (F.col("support") - F.col("s_a") * F.col("s_c")).alias("leverage"),
                    F.when(F.col("confidence") >= 1.0, F.lit(float("inf")))
                    .otherwise((F.lit(1.0) - F.col("s_c")) / (F.lit(1.0) - F.col("confidence"))).alias("conviction"))


def rule_order() -> list[Column]:
    """TK-02: confidence, lift, support descending; ties broken by the joined
    antecedents then consequents (the reference's order is unstable)."""
    return [F.col("confidence").desc(), F.col("lift").desc(), F.col("support").desc(),
            F.array_join("antecedents", ",").asc(), F.array_join("consequents", ",").asc()]


def top_rules(rules: DataFrame, max_rules: int = 200, group=("ticker",)) -> DataFrame:
    """ST-02 + TK-03: keep the best rule per combined itemset, then the first
    ``max_rules`` per group, with their rank."""
    g = _g(group)
    full = F.array_sort(F.concat("antecedents", "consequents"))
    r = rules.withColumn("_full", full)
    r = r.withColumn("_k", F.row_number().over(Window.partitionBy(*g, "_full").orderBy(*rule_order())))
    r = r.where(F.col("_k") == 1).drop("_k", "_full")
    r = r.withColumn("rank", F.row_number().over(Window.partitionBy(*g).orderBy(*rule_order())))
    return r.where(F.col("rank") <= max_rules)


def mine_rules(df: DataFrame, min_support: float = 0.05, min_confidence: float = 0.5,
               max_rules: int = 200, part: str = "ticker") -> DataFrame:
    """ML-22 end to end: baskets → itemsets → rules → sort, dedup, cap.  A
    ticker without frequent itemsets simply has no rule rows."""
    freq = frequent_itemsets(build_baskets(df, part), min_support, [part])
    return top_rules(all_rules(freq, min_confidence, [part]), max_rules, [part])


def rules_with_items(rules: DataFrame, a: str, b: str) -> DataFrame:
    """ST-04: rules whose items contain both ``a`` and ``b``."""
    allit = F.concat("antecedents", "consequents")
    return rules.where(F.array_contains(allit, a) & F.array_contains(allit, b))


def item_cooccurrence(rules: DataFrame, group=("ticker",)) -> DataFrame:
    """AG-22: ordered item pairs (i ≠ j) counted over rules."""
    g = _g(group)
    r = rules.select(*g, F.array_distinct(F.concat("antecedents", "consequents")).alias("_it"))
    pairs = r.select(*g, F.explode("_it").alias("a"), "_it")
    pairs = pairs.select(*g, "a", F.explode(F.filter("_it", lambda x: x != F.col("a"))).alias("b"))
    return pairs.groupBy(*g, "a", "b").agg(F.count(F.lit(1)).alias("n_rules"))
