"""Document fingerprints by a threshold-scaled sketch.

A sketch keeps every five-word shingle hash below a fixed fraction of the hash
range.  Its size follows the document, so the share of one sketch that lies in
another estimates containment even between very unequal documents, and the
union of two sketches is the sketch of both texts.

Comparing each document with the next by id needs neighbours together: ids
(without texts) give range bounds, every range is one task's stream, and the
first row of a range is also sent to the range before it.  The texts are
shuffled once and no window spans the table.
"""
from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import NULL_ID, ship, table, whole_text

SHINGLE_WORDS = 5
#: One hash in so many is kept.
SCALE = 4
_P, _A, _B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: Most word hashes a worker keeps.
CACHE_WORDS = 500_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def sketch(words: list[bytes], shingle: int = SHINGLE_WORDS, scale: int = SCALE) -> np.ndarray:
    """Sorted distinct shingle hashes below ``2**64 / scale``; a shorter text is one shingle, an empty one has none."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    k = min(shingle, len(h))
    with np.errstate(over="ignore"):
        x = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            x = x * _P + h[i:len(h) - k + 1 + i]
        x = (x ^ (x >> np.uint64(30))) * _A
        x = (x ^ (x >> np.uint64(27))) * _B
        x ^= x >> np.uint64(31)
    return np.unique(x[x < np.uint64((1 << 64) // scale)] if scale > 1 else x)


def split_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.union1d(a, b)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of ``a``'s shingles that ``b`` has; 0 if ``a`` has none."""
    return float(np.isin(a, b, assume_unique=True).sum() / len(a)) if len(a) else 0.0


def likeness(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> float:
    """1 for equal fingerprints, else the containment of the smaller sketch in the larger."""
    if a[0] == b[0]:
        return 1.0
    small, large = sorted((a[1], b[1]), key=len)
    return containment(small, large)


def fingerprint(text: str) -> tuple[str, np.ndarray]:
    """``digest of the words : sketch in base 64`` and the sketch; the digest tells texts apart whose sketches are empty."""
    words = split_words(text)
    s = sketch(words)
    return f"{xxhash.xxh64_hexdigest(b' '.join(words))}:{base64.b64encode(s.astype('>u8').tobytes()).decode()}", s


def edited(text: str, following: str) -> str:
    """The last half of the text (rounded down) replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _range_of(id_: Column, bounds: list[int], step: int = 128) -> Column:
    """How many bounds are at most the id, looked up in two levels."""
    if not bounds:
        return F.lit(0)
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    count = lambda values: F.size(F.filter(values, lambda b: b <= id_))
    if len(groups) == 1:
        return count(F.lit(bounds))
    k = count(F.lit([g[0] for g in groups]))
    return F.when(k == 0, 0).otherwise((k - 1) * step + count(F.get(F.array(*[F.lit(g) for g in groups]), F.greatest(k - 1, F.lit(0)))))


def with_next(docs: DataFrame, id_col: str, text_col: str, ranges: int | None = None) -> DataFrame:
    """Rows ``(r, extra, id, tie, text)`` dealt by range ``r`` and sorted in it: a row's next document is the row below.

    ``extra`` marks the copy of the next range's first row that ends a range.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("id"), whole_text(text_col).alias("text"))
    cuts = rows.agg(F.percentile_approx("id", F.lit([k / ranges for k in range(1, ranges)]), F.lit(20 * ranges)).alias("q")).first()["q"] if ranges > 1 else []
    r = _range_of(F.col("id"), sorted(set(cuts or []))).cast("int").alias("r")
    firsts = rows.select(r, "id").groupBy("r").agg(F.min("id").alias("id")).orderBy("r").collect()  # a row per range
    dealt = rows.select(r, F.lit(0).alias("extra"), "id", F.xxhash64("text").alias("tie"), "text")
    ends = [(f["id"], firsts[k - 1]["r"]) for k, f in enumerate(firsts)]
    if not ends:
        return dealt
    small = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(i).alias("first"), F.lit(to).alias("to")) for i, to in ends])))
    places = F.array(F.struct("r", "extra"), F.struct(F.col("to").alias("r"), F.lit(1).alias("extra")))
    both = dealt.join(F.broadcast(small), F.col("id") == F.col("first"), "left").select(F.explode(F.filter(places, lambda x: x["r"].isNotNull())).alias("at"), "id", "tie", "text")
    return both.select("at.r", "at.extra", "id", "tie", "text").repartition(ranges, "r").sortWithinPartitions("r", "extra", "id", "tie", "text")


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """The contract's rows, one per input row.

    Null text is empty.  Rows stand in the order of id, nulls last, repeated
    ids by text; the last one's next is the first, a single row's next itself.
    Other columns are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far: range, id, text, its fingerprint
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = [[] for _ in names]
                for r, extra, id_, text in zip(*[part.column(i).to_pylist() for i in (0, 1, 2, 4)]):
                    own = fingerprint(text)
                    if held and held[0] == r:
                        _, past, before, mark = held
                        new = edited(before, text)
                        other = fingerprint(new)
                        row = (None if past == NULL_ID else past, len(before), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), mark[0], other[0], likeness(mark, other), likeness(mark, own))
                        for o, v in zip(out, row):
                            o.append(v)
                    if not extra:
                        held = (r, id_, text, own)
                    else:
                        held = None  # only the first copy is a neighbour
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], names=names)

    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return with_next(docs, id_col, text_col, ranges).mapInArrow(run, schema)


def op9_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))
