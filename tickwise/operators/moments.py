"""Grouped moment matrices in one pass (AG-14, ML-09, ML-10, PRJ-05).

A task turns its Arrow batches into one partial per group: row count, means and
centred cross products as matrix products of shifted blocks.  Partials of a
group meet in a shuffle of small rows and are merged two by two (counts, means
and products about the joint mean), which stays exact to rounding whatever the
size of the means.  Columns without a missing value share one count and mean;
only a block that holds a NULL carries counts and means per pair.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tickwise.session import ship

#: Groups a task holds before it hands their partials on.
HELD_GROUPS = 4096


class Moments:
    """Mergeable moments of rows of ``p`` numbers.

    ``n``, ``mean`` and ``products`` serve complete rows; ``pairs`` holds
    (counts, means of i over rows with i and j, squares of i about that mean,
    products) as p × p matrices once a value is missing.
    """

    __slots__ = ("rows", "mean", "products", "pairs")

    def __init__(self, rows: int, mean: np.ndarray, products: np.ndarray, pairs: tuple | None = None):
        self.rows, self.mean, self.products, self.pairs = rows, mean, products, pairs

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        """Of a block of rows; NaN is a missing value."""
        there = ~np.isnan(x)
        if there.all():
            shift = x[0]
            d = x - shift
            m = d.mean(axis=0)
            d -= m
            return cls(len(x), shift + m, d.T @ d)
        first = there.argmax(axis=0)
        shift = np.where(there.any(axis=0), x[first, np.arange(x.shape[1])], 0.0)
        d = np.where(there, x - shift, 0.0)
        m = d.sum(axis=0) / np.maximum(there.sum(axis=0), 1)
        d = np.where(there, d - m, 0.0)  # a constant column is zero here, exactly
        w = there.astype(float)
        n, sums = w.T @ w, d.T @ w
        share = np.divide(sums, n, out=np.zeros_like(sums), where=n > 0)
        squares = (d * d).T @ w - sums * share
        products = d.T @ d - sums * share.T
        return cls(len(x), np.zeros(x.shape[1]), np.zeros_like(n), (n, (shift + m)[:, None] + share, squares, products))

    def by_pairs(self) -> tuple:
        if self.pairs:
            return self.pairs
        p = len(self.mean)
        return (np.full((p, p), float(self.rows)), np.repeat(self.mean[:, None], p, axis=1), np.repeat(np.diag(self.products)[:, None], p, axis=1), self.products)

    def merge(self, other: Moments) -> Moments:
        rows = self.rows + other.rows
        if not self.pairs and not other.pairs:
            gap = other.mean - self.mean
            return Moments(rows, self.mean + gap * (other.rows / rows), self.products + other.products + np.outer(gap, gap) * (self.rows * other.rows / rows))
        (na, ma, va, ca), (nb, mb, vb, cb) = self.by_pairs(), other.by_pairs()
        n = na + nb
        part = np.divide(nb, n, out=np.zeros_like(n), where=n > 0)
        gap = np.where((na > 0) & (nb > 0), mb - ma, 0.0)
        weight = na * part
        mean = np.where(na > 0, ma + gap * part, mb)
        return Moments(rows, self.mean, self.products, (n, mean, va + vb + gap * gap * weight, ca + cb + gap * gap.T * weight))

    def pack(self) -> bytes:
        return b"".join(m.tobytes() for m in (self.pairs or (self.mean, self.products)))

    @classmethod
    def unpack(cls, rows: int, data: bytes, p: int) -> Moments:
        x = np.frombuffer(data, float)
        if len(x) == p + p * p:
            return cls(rows, x[:p], x[p:].reshape(p, p))
        return cls(rows, np.zeros(p), np.zeros((p, p)), tuple(x.reshape(4, p, p)))

    def correlation(self) -> np.ndarray:
        """Pearson correlation over the rows with both values; 0 where it has none."""
        _, _, v, c = self.by_pairs()
        scale = np.sqrt(v * v.T)
        return np.divide(c, scale, out=np.zeros_like(c), where=scale > 0)


def _block(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])


def _groups(batch: pa.RecordBatch, ng: int) -> tuple[list[tuple], np.ndarray]:
    """The distinct values of the first ``ng`` columns, and each row's number among them."""
    if ng == 0:
        return [()], np.zeros(batch.num_rows, int)
    if ng == 1:
        coded = pc.dictionary_encode(batch.column(0), null_encoding="encode")
        return [(v,) for v in coded.dictionary.to_pylist()], coded.indices.to_numpy(zero_copy_only=False)
    seen: dict[tuple, int] = {}
    index = [seen.setdefault(key, len(seen)) for key in zip(*[c.to_pylist() for c in batch.columns[:ng]])]
    return list(seen), np.array(index)


def grouped_moments(df: DataFrame, cols: list[str], group: list[str], schema: str, finish: Callable[[dict, Moments], list[tuple]], complete: bool = False) -> DataFrame:
    """``finish(group values, moments)`` gives the rows of ``schema`` after the group's columns.

    NULL, NaN and infinities are missing (PRJ-02); ``complete`` leaves out rows
    that miss a value (PRJ-03), and groups without a complete row.  Only partials are shuffled: a hot group sends
    one a task, and a task merges a group as its partials stream by.
    """
    ship(df.sparkSession)
    p, ng = len(cols), len(group)
    rows = df.select(*group, *[F.col(c).cast("double") for c in cols])
    keys = rows.select(*group).schema
    part = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in keys.fields], "rows bigint", "moments binary"])

    out_schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in keys.fields], schema])
    part_arrow, out_arrow = (to_arrow_schema(_parse_datatype_string(s)) for s in (part, out_schema))

    def batch_of(shape: pa.Schema, made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), shape)], schema=shape)

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Moments] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _block(batch.select(list(range(ng, ng + p))))
            there = np.isfinite(x)
            if complete and not there.all():
                whole = there.all(axis=1)
                x, batch = x[whole], batch.filter(pa.array(whole))
                if not len(x):
                    continue
            elif not there.all():
                x = np.where(there, x, np.nan)
            names, index = _groups(batch, ng)
            order = np.argsort(index, kind="stable")
            edge = np.flatnonzero(np.diff(index[order], prepend=-1))
            for a, b in zip(edge, [*edge[1:], len(order)]):
                key, new = names[index[order[a]]], Moments.of(x[order[a:b]])
                held[key] = held[key].merge(new) if key in held else new
            if len(held) > HELD_GROUPS:
                yield batch_of(part_arrow, [(*k, m.rows, m.pack()) for k, m in held.items()])
                held = {}
        if held:
            yield batch_of(part_arrow, [(*k, m.rows, m.pack()) for k, m in held.items()])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sum_, made = None, None, []
        for batch in batches:
            for *key, n, data in zip(*[c.to_pylist() for c in batch.columns]):
                new = Moments.unpack(n, data, p)
                if sum_ is not None and key == now:
                    sum_ = sum_.merge(new)
                    continue
                if sum_ is not None:
                    made += [(*now, *r) for r in finish(dict(zip(group, now)), sum_)]
                now, sum_ = key, new
                if len(made) > 1024:
                    yield batch_of(out_arrow, made)
                    made = []
        if sum_ is not None:
            made += [(*now, *r) for r in finish(dict(zip(group, now)), sum_)]
        if made:
            yield batch_of(out_arrow, made)

    sent = rows.mapInArrow(partials, part)
    dealt = sent.repartition(*group).sortWithinPartitions(*group) if group else sent.coalesce(1)
    return dealt.mapInArrow(merged, out_schema)
