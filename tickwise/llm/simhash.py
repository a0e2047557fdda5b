"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's 64-bit fingerprint is the bitwise majority of the XXH64 values of its
three-word shingles.  Two fingerprints link when they differ in at most three
bits.  The search is exact: every bit position gets a non-zero vector of
GF(2)^4, a table v keeps the bits whose vector has an odd product with v, and
for any three differing bits some non-zero v is orthogonal to all three, so
the pair agrees on everything that table keeps.  15 tables therefore hold
every pair within the radius.

Scale: exact copies collapse to one row per fingerprint before any table is
built.  Buckets are counted with partial aggregation first; only those of two
or more fingerprints go on.  A bucket over ``max_group`` is not searched
whole: its members are spread over 15 sub-tables of the bits its mask leaves
open, after which a bucket's members agree on all but about 14 bits, so it
holds at most 2^open of them however large the corpus is.  A bucket yields
the edges of a spanning forest, never its pairs.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import NULL_ID, cut, map_rows, settle, ship, table, whole_text

SHINGLE_WORDS = 3
RADIUS = 3
BITS = 64
#: Most members of a bucket that is searched without being spread again.
MAX_GROUP = 1024


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over the given bit positions: any ``radius`` of them are all left out by some mask."""
    size = 2 ** (radius + 1)
    vector = {b: 1 + i % (size - 1) for i, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (vector[b] & v).bit_count() % 2) for v in range(1, size)]


MASKS = covering_masks(list(range(BITS)), RADIUS)
#: For each table, the masks of its sub-tables: the table's own bits and a covering of the open ones.
SUB_MASKS = [[m | s for s in covering_masks([b for b in range(BITS) if not m >> b & 1], RADIUS)] for m in MASKS]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint; zero for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and exactly the word separators
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        joined = memoryview(b" ".join(words))
        starts = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
        ends = (starts[shingle:] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends)]
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = np.array(hashes[at:at + 65536], "<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * total > len(hashes)).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id bigint, fp bigint)`` per row; null text counts as empty, a null id stays null."""
    def run(cols):
        ids, texts = cols
        return [ids, [_signed(fingerprint(t)) for t in texts]]

    return map_rows(docs.select(F.col(id_col).cast("bigint"), whole_text(text_col)), "id bigint, fp bigint", run)


def forest(fps: np.ndarray, nodes: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges ``(node, smallest node)`` joining each set of fingerprints connected within ``radius``."""
    order = np.argsort(nodes, kind="stable")
    fps, nodes = fps[order], nodes[order]
    left, edges = np.arange(len(fps)), []
    while len(left):
        root, left = left[0], left[1:]
        todo = [root]
        while todo and len(left):
            near = np.bitwise_count(fps[left] ^ fps[todo.pop()]) <= radius
            hit, left = left[near], left[~near]
            todo += hit.tolist()
            edges += [(int(nodes[x]), int(nodes[root])) for x in hit]
    return edges


def _bucket_edges(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """Spanning edges of every bucket; ``members`` of a bucket is bounded by the caller."""
    @F.pandas_udf("array<struct<a:bigint,b:bigint>>")
    def edges(fps: pd.Series, nodes: pd.Series) -> pd.Series:
        return pd.Series([forest(np.asarray(f, np.int64).view(np.uint64), np.asarray(n, np.int64)) for f, n in zip(fps, nodes)])

    ship(buckets.sparkSession)
    lists = buckets.groupBy(*keys).agg(F.collect_list("fp").alias("fps"), F.collect_list("node").alias("nodes"))
    return lists.filter(F.size("fps") > 1).select(F.explode(edges("fps", "nodes")).alias("e")).select("e.a", "e.b")


def _keyed(df: DataFrame, masks) -> DataFrame:
    """A row per table: its number ``v`` and the kept bits as ``key``."""
    pairs = F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for v, m in enumerate(masks)])
    return df.select("fp", "node", F.explode(pairs).alias("t")).select("fp", "node", "t.v", "t.key")


def links(classes: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """Edges ``(a, b)`` that connect all fingerprints ``(fp, node)`` linked within the radius; fps are distinct."""
    rows = _keyed(classes, MASKS)
    sizes = rows.groupBy("v", "key").agg(F.count("*").alias("members")).filter("members > 1")
    shared = rows.join(sizes, ["v", "key"])  # read twice below; both readings reuse its two exchanges
    small = _bucket_edges(shared.filter(F.col("members") <= max_group), ["v", "key"])
    subs = F.lit(None)
    for v, masks in enumerate(SUB_MASKS):
        subs = F.when(F.col("v") == v, F.array(*[F.struct(F.lit(s).alias("s"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("sub")) for s, m in enumerate(masks)])).otherwise(subs)
    spread = shared.filter(F.col("members") > max_group).select("fp", "node", "v", F.explode(subs).alias("t")).select("fp", "node", "v", "t.s", "t.sub")
    return small.unionByName(_bucket_edges(spread, ["v", "s", "sub"]))


def components(edges: DataFrame, rows: int = 0) -> DataFrame:
    """``(node, root)`` for every node of the edges: root is the smallest node reachable; ``rows`` is their expected number.

    Alternating large-star and small-star rounds; each is a partial minimum per
    node and a join on it, so a node with very many edges never gathers in one
    task.  Rounds end when every edge leads to a root that is no edge's start.
    """
    def star(pairs: DataFrame, up: bool) -> DataFrame:
        best = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = pairs.join(best, "u")
        if up:
            return joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(best.select(F.col("u").alias("a"), F.col("m").alias("b")))

    def state(pairs: DataFrame) -> tuple[int, int]:
        """Number of edges, and of nodes that keep the edge set from being final."""
        ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.lit(1).alias("out"), F.lit(0).alias("in")), F.struct(F.col("b").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("in")))).alias("e"))
        degrees = ends.groupBy("e.u").agg(F.sum("e.out").alias("out"), F.max("e.in").alias("in"))
        row = degrees.agg(F.coalesce(F.sum("out"), F.lit(0)).alias("n"), F.count_if(F.expr("out > 1 or out > 0 and `in` > 0")).alias("open")).first()
        return row["n"], row["open"]

    # only what an aggregate leaves is settled: many sorts of a join in one task would each hold memory to its end
    edges = cut(settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), rows))
    while (now := state(edges))[1]:
        both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")
        large = star(both, True).filter("a <> b")
        edges = cut(settle(star(large.select(F.col("a").alias("u"), F.col("b").alias("v")), False).filter("a <> b").distinct(), now[0]))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_group: int = MAX_GROUP) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per input row.

    Null text is empty; texts without words share fingerprint zero and link like
    any other.  A null id keeps its row and counts as larger than every id, so a
    component of null ids alone has a null component_id.  Repeated rows give
    repeated result rows.  An empty table gives an empty result.
    """
    fps = cut(fingerprints(docs, id_col, text_col))
    classes = fps.groupBy("fp").agg(F.min(F.coalesce("id", F.lit(NULL_ID))).alias("node"))
    classes = cut(settle(classes, fps.count()))
    count = classes.count()
    # two classes may share a smallest id when ids repeat: such rows are one node already
    roots = components(links(classes, max_group), count)
    named = classes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("root"))
    out = fps.join(named, "fp")
    return out.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("root") != NULL_ID, F.col("root")).alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each component: its smallest id.

    Where that id itself repeats, the row first by text stays.  A row without
    an id cannot stand for a component: such rows lose exact copies only.
    """
    found = near_duplicates(docs, id_col, text_col)
    first = found.filter("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct()
    own = F.col(id_col).cast("bigint")
    kept = docs.filter(own.isNotNull()).join(first, own == F.col("__id"), "left_semi").unionByName(docs.filter(own.isNull()))
    order = Window.partitionBy(F.col(id_col), F.when(own.isNull(), F.xxhash64(text_col))).orderBy(F.xxhash64(text_col), F.col(text_col))
    return kept.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
