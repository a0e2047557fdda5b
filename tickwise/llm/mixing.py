"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a target number of words: its weight's share of the mix,
never above ``max_copies`` times what it has.  A schedule says how a source's
share changes over the training run; its integral is the source's cumulative
demand.  A source's documents stand in a fixed random order and are taken one
after the other until its target is met, again from the first if one pass is
not enough; the point of the run at which the cumulative demand reaches a
document is its position, and the mix is range-sorted by position.

Scale: nothing is windowed over a whole source.  A source's order is the high
bits of a hash, so its prefix sums come in two levels: sums per (source, hash
bucket) and windows inside one bucket of about ``bucket_rows`` rows.  A source
that holds a third of the rows only has more buckets.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import WORD, cut, table, whole_text

#: Weights by the rank of a source (code-point order, null last), repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Share of the sum of all sizes that the mix holds.
BUDGET = 1.5
#: No document is taken more often, and no target is above this times a source's size.
MAX_COPIES = 2
#: Weight at the start and the end of the run, linear between, by the same rank.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
BUCKET_ROWS = 20_000


def sizes(docs: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with ``__size`` (words; null text: 0) and ``__source``, a key that tells null from any string."""
    return docs.withColumns({
        "__size": F.regexp_count(whole_text(text_col), F.lit(WORD)).cast("long"),
        "__source": F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("z")),  # "z": after any "s..."
    })


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0 in the order of ``__source``, without gathering them in one task."""
    spread = cut(sources.repartitionByRange("__source").withColumn("__p", F.spark_partition_id()))
    before, offsets = 0, []
    for r in sorted(spread.groupBy("__p").count().collect()):  # a row per partition
        offsets.append(F.struct(F.lit(r["__p"]).alias("__p"), F.lit(before).cast("long").alias("__before")))
        before += r["count"]
    if not offsets:
        return spread.withColumn("rank", F.lit(0).cast("long")).drop("__p")
    first = sources.sparkSession.range(1).select(F.inline(F.array(*offsets)))
    inside = F.row_number().over(Window.partitionBy("__p").orderBy("__source"))
    return spread.join(F.broadcast(first), "__p").withColumn("rank", F.col("__before") + inside - 1).drop("__p", "__before")


def targets(sources: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_copies: float = MAX_COPIES) -> DataFrame:
    """``sources`` (``__source``, ``source_size``) with ``rank`` and ``target``.

    Water filling: a source whose share would pass its cap stays at the cap,
    and what is left is shared again by weight until none is above.  Each
    round is one aggregate over the sources; a round without a newly capped
    source is the last.
    """
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int"))
    t = cut(ranked(sources).withColumns({"__w": weight, "__cap": max_copies * F.col("source_size").cast("double")}))
    total = t.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = F.col("__cap") < F.col("__w") * level if capped >= 0 else F.lit(False)
        row = t.agg(F.count(F.when(over, 1)).alias("n"), F.sum(F.when(over, F.col("__cap"))).alias("held"), F.sum(F.when(~over, F.col("__w"))).alias("free")).first()
        if row["n"] == capped or not row["free"]:
            break
        capped, level = row["n"], (budget * total - (row["held"] or 0.0)) / row["free"]
    return t.withColumn("target", F.least(F.col("__cap"), F.col("__w") * F.lit(float(level)))).drop("__w", "__cap")


def position(share: Column, start: Column, end: Column) -> Column:
    """The time in [0, 1] at which the integral of a linear schedule has reached ``share`` of its whole."""
    slope, whole = end - start, (start + end) / 2
    root = F.sqrt(F.greatest(start * start + 2 * slope * share * whole, F.lit(0.0)))
    return F.when(F.abs(slope) < 1e-12, share).otherwise((root - start) / F.when(slope == 0, 1.0).otherwise(slope))


def placed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", keep: list[str] = (), weights=WEIGHTS, schedules=SCHEDULES, budget: float = BUDGET, max_copies: int = MAX_COPIES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """A row per document with ``size``, ``source_size``, ``target``, ``taken`` and ``positions`` (one for each copy, in [0, 1]).

    The sizes are cut to a table once; texts are not shuffled.
    """
    order = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit("mix")), 1)  # 63 bits, never negative: buckets follow the order
    rows = sizes(docs, source_col, text_col).select(F.col(id_col).alias("__id"), F.col("__size"), F.col("__source"), F.xxhash64(whole_text(text_col)).alias("__tie"), order.alias("__h"), *keep)
    rows = cut(rows)
    buckets = 1 << max(0, (rows.count() // bucket_rows).bit_length())
    rows = rows.withColumn("__b", F.shiftright("__h", 63 - (buckets.bit_length() - 1)) if buckets > 1 else F.lit(0).cast("bigint"))
    sums = cut(rows.groupBy("__source", "__b").agg(F.sum("__size").alias("__sum")))
    goals = targets(sums.groupBy("__source").agg(F.sum("__sum").alias("source_size")), weights, budget, max_copies)
    before = F.sum("__sum").over(Window.partitionBy("__source").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    level = sums.withColumn("__before", F.coalesce(before, F.lit(0))).join(goals, "__source").drop("__sum")
    by = Window.partitionBy("__source", "__b").orderBy("__h", "__id", "__tie").rowsBetween(Window.unboundedPreceding, -1)
    placed_ = rows.withColumn("__in", F.coalesce(F.sum("__size").over(by), F.lit(0))).join(level, ["__source", "__b"])
    at, size, goal = F.col("__before") + F.col("__in"), F.col("__size"), F.col("target")
    # copy k of a document spans words k * source_size + at and on; it is taken if its middle is below the target
    copies = F.filter(F.array(*[F.lit(k) for k in range(max_copies)]), lambda k: (size > 0) & (k * F.col("source_size") + at + size / 2 < goal))
    start, end = (F.get(F.array(*[F.lit(float(s[i])) for s in schedules]), (F.col("rank") % len(schedules)).cast("int")) for i in (0, 1))
    times = F.transform(copies, lambda k: position(F.least(F.lit(1.0), (k * F.col("source_size") + at + size / 2) / goal), start, end))
    return placed_.select(
        F.col("__id").alias(id_col), size.alias("size"), "source_size", "target",
        (F.size(copies) * size).cast("long").alias("taken"), times.alias("positions"), F.col("__h").alias("__h"), F.col("__tie"), *keep,
    )


def mixing_plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **params) -> DataFrame:
    """The contract's rows, one per input row, range-sorted by the first position (documents left out come last).

    Null text has size 0 and is never taken; a null source is a source, last
    in order; null ids and repeated rows keep a row each.  With no words at
    all every target is 0.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    plan = placed(docs, **params).withColumn("position", F.get("positions", 0))
    order = [F.col("position").asc_nulls_last(), F.col("__h"), F.col("doc_id")]
    return plan.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "size", "source_size", "target", "taken", "position", "positions")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **params) -> DataFrame:
    """The mix itself: each document as often as it is taken, range-sorted by position; same columns as ``docs``."""
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    docs_ = docs.withColumnsRenamed(names)
    own_id, own_source, own_text = names[id_col], names[source_col], names[text_col]
    plan = placed(docs_, own_id, own_source, own_text, **params).filter("size(positions) > 0").select(own_id, "__tie", "positions")
    # repeated rows are alike in id and text, and each takes its own positions: they meet one to one by number
    n = F.row_number().over(Window.partitionBy(own_id, "__tie").orderBy(F.lit(1)))
    marked = docs_.withColumn("__tie", F.xxhash64(whole_text(own_text))).withColumn("__n", n)
    plan = plan.withColumn("__n", F.row_number().over(Window.partitionBy(own_id, "__tie").orderBy("positions")))
    plan = plan.withColumnsRenamed({own_id: "__id", "__tie": "__t", "__n": "__m"})
    taken = marked.join(plan, F.col(own_id).eqNullSafe(F.col("__id")) & (F.col("__tie") == F.col("__t")) & (F.col("__n") == F.col("__m")))
    order = [F.col("__position"), F.col("__tie"), F.col(own_id)]
    out = taken.select(*names.values(), "__tie", F.explode("positions").alias("__position")).repartitionByRange(*order).sortWithinPartitions(*order)
    return out.select(*[F.col(v).alias(k) for k, v in names.items()])


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return mixing_plan(table(spark, sf_dir, "documents"))
