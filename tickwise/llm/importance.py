"""Target-distribution importance resampling with Arrow kernels.

Texts become words by ``ascii_lower``, ``split_pattern_regex`` and
``list_flatten``; ``dictionary_encode`` numbers the words of a batch, and
shifted numbers form the n-grams.  Only distinct (n-gram, next word) pairs are
hashed: CRC-32 goes on from the shorter n-gram's value.  Buckets are counted
over all raw and all target texts, each bucket's gain is the logarithm of its
smoothed likelihood ratio, and a document's weight is the mean of its
features' gains, taken by bucket and summed by segment.  Gumbel noise from a
hash of the id turns the highest scores into a draw without replacement.

Scale: counting sends at most one row a bucket and task, and the gains are one
number a bucket, so what the driver and the tasks hold is fixed by ``buckets``.
Ranks come from a range sort of narrow rows and the row counts of its parts.
"""
from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import cut, ship, table, whole_text

#: Fixed value: what stands between words, once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, LONGEST, SEED, LEAST_WORDS, PERCENT = 10_000, 1, 2024, 20, 10
#: Rows a task of the final sort should get.
SORT_ROWS = 1_000_000


def features(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row number of every feature of a batch, and the words of each row."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    words = pc.list_flatten(parts)
    real = pc.not_equal(words, "")
    row, words = row[real.to_numpy(zero_copy_only=False)], words.filter(real)
    coded = pc.dictionary_encode(words)
    word = coded.indices.to_numpy().astype(np.int64)
    names = [w.encode() for w in coded.dictionary.to_pylist()]
    gram, crc = word, np.fromiter(map(zlib.crc32, names), np.uint32, len(names))
    found, rows = [crc[gram] % buckets], [row]
    for n in range(2, longest + 1):
        # an n-gram is the one of n - 1 words before it and the next word, within one text
        inside = row[:len(row) - n + 1] == row[n - 1:]
        pair = gram[:len(inside)] * len(names) + word[n - 1:]
        distinct, of = np.unique(pair[inside], return_inverse=True)
        before, last = np.divmod(distinct, max(1, len(names)))
        crc = np.fromiter((zlib.crc32(b" " + names[w], c) for c, w in zip(crc[before].tolist(), last.tolist())), np.uint32, len(distinct))
        gram = np.zeros(len(inside), np.int64)
        gram[inside] = of
        found.append(crc[of] % buckets)
        rows.append(row[:len(inside)][inside])
    return np.concatenate(found).astype(np.int64), np.concatenate(rows), np.bincount(row, minlength=len(texts))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            yield batch.slice(at, 512)


def bucket_counts(docs: DataFrame, text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in _slices(batches):
            total += np.bincount(features(part.column(0), longest, buckets)[0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    rows = docs.select(whole_text(text_col)).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:  # a row a bucket at most
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log of the smoothed likelihood ratio of each bucket, floored."""
    s_all, t_all = float(raw.sum() + len(raw)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """A thousand times a Gumbel draw, floored: the same for an id at every run."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_features, n_words, weight, score)`` of every document."""
    ship(docs.sparkSession)
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            bucket, row, words = features(part.column(1), longest, buckets)
            n = np.bincount(row, minlength=part.num_rows)
            # segment sums in whole numbers: rows of longer n-grams follow those of shorter ones, so sort by row first
            order = np.argsort(row, kind="stable")
            ends = np.cumsum(n)
            sums = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
            weight = np.where(n > 0, (sums[ends] - sums[ends - n]) // np.maximum(n, 1), 0)
            score = weight + np.array([noise(d, seed) for d in part.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (n, words, weight, score))], names=["doc_id", "n_features", "n_words", "weight", "score"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), whole_text(text_col)).mapInArrow(run, "doc_id bigint, n_features bigint, n_words bigint, weight bigint, score bigint")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, sort_rows: int = SORT_ROWS) -> DataFrame:
    """``scored`` with ``rank`` 1, 2, 3 ... of the drawn documents, null for the others."""
    spark = scored.sparkSession
    # numbered once written: rows that are alike in everything still have an order, and a range of the sort can end between them
    scored = cut(scored).withColumn("tie", F.monotonically_increasing_id())
    fit = F.col("n_words") >= least_words
    n = scored.filter(fit).count()
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("tie")]
    parts = max(spark.sparkContext.defaultParallelism, -(-n // sort_rows))
    ranked = cut(scored.filter(fit).repartitionByRange(parts, *order).sortWithinPartitions(*order))
    ranked = ranked.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = dict(ranked.groupBy("part").count().collect())  # a number a task
    before = [*accumulate([sizes.get(p, 0) for p in range(max(sizes, default=0) + 1)], initial=0)]
    starts = spark.createDataFrame(list(enumerate(before)), "part int, before bigint")
    rank = F.col("before") + F.col("at") + 1
    ranked = ranked.join(F.broadcast(starts), "part").withColumn("rank", F.when(rank <= percent * n // 100, rank))
    return ranked.drop("part", "at", "before", "tie").unionByName(scored.filter(~fit).drop("tie").withColumn("rank", F.lit(None).cast("bigint")))


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """``(doc_id, n_features, n_words, weight, score, rank)``: a row per document, ``rank`` set for those drawn towards ``target``.

    Null and empty texts have no features and weigh 0; a null id's noise is
    that of the empty id, and it comes last among equal scores; repeated rows
    count, weigh and rank each, in an order that changes no row; empty tables
    count nothing; other columns are left out.
    """
    gain = gains(bucket_counts(docs, text_col, longest, buckets), bucket_counts(target, target_col, longest, buckets))
    return draw(weigh(docs, gain, longest, seed, id_col, text_col), percent, least_words)


def op12_importance(spark, sf_dir: str) -> DataFrame:
    rows = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def _words_sql(name: str, key: str) -> str:
    return f"""SELECT {key}, unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) AS w FROM {name}"""


ORACLE = f"""
WITH d AS ({_words_sql("documents", "doc_id")}), b AS ({_words_sql("benchmark", "item_id")}),
steps AS (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(list_prepend(n::BIGINT, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(n))),
vocab AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM d UNION SELECT w FROM b)),
hashed AS (SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda a, z: xor(a >> 8, t[(xor(a, z) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket FROM vocab, steps),
s AS (SELECT bucket, count(*) AS s FROM d JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN hashed USING (w) GROUP BY bucket),
g AS (SELECT r.bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM d) + {BUCKETS})::DOUBLE
        / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM b) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
    FROM range({BUCKETS}) r(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
m AS (SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM d JOIN hashed USING (w) JOIN g USING (bucket) GROUP BY doc_id),
p AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM documents LEFT JOIN m USING (doc_id))
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {LEAST_WORDS} AND r <= {PERCENT} * all_n // 100 THEN r END AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS r,
    count(*) OVER (PARTITION BY n_features >= {LEAST_WORDS}) AS all_n FROM p)
"""
