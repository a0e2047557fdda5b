"""Prefix trie of conversations as burst tries.

Turns become 128-bit ids, conversations sequences of ids, and equal sequences
one row per block of members.  The root is a trie head: below a head, the
sequences with one next turn share a container of suffixes.  A container of
too many rows is burst by the next turn id, so its top becomes a head as well.
The remaining containers are dealt over the tasks, sorted by their sequences
and swept: one pass with the open path on a stack gives every node below the
heads; heads are summed up from what lies directly under them.

Scale: only ids are shuffled, never texts.  A hot first turn, or a passage that
many conversations begin with, is burst until its containers are small; bursts
look at 1, 2, 4, 8 ... further turns at a time, so a long common beginning costs
few rounds.  A container may hold ``rows / HEADS`` rows, so there are at most
``HEADS`` heads of a depth, which is what the driver and the tasks hold.  Members
of equal sequences travel as text of up to 65,536 ids a row and are hashed as
they stream by.  A conversation's ids are one row of 20 bytes a turn.
"""
from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import cut, ship, table

#: Bytes of a turn's id and of a text's length; members of a block of equal sequences; rows of a batch that leaves a task.
ID, SIZE, BLOCK_BITS, OUT_ROWS = 16, 4, 16, 8192
#: Containers of so many rows are never burst; beyond that, the most heads of a depth.
LEAST_ROWS, HEADS = 1024, 2048
ROOT = bytes(ID)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_ids(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, id, size)`` of ``(conv_id, turn, role, text)``: null role or text is empty, rows without a conversation go."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return rows.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.substring(F.sha2(name, 256), 1, 2 * ID)).alias("id"), F.octet_length(text).alias("size"))


def _write(names: list[str], types: list[pa.DataType], rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, OUT_ROWS):
            part = batch.slice(at, OUT_ROWS)
            yield from zip(*[c.to_pylist() for c in part.columns])


SEQUENCE = "conv_id bigint, ids binary, sizes binary"
_SEQUENCE = [pa.int64(), pa.binary(), pa.binary()]


def own_sequences(rows: DataFrame) -> DataFrame:
    """Each conversation's turns in order (null first, then by id) as one row."""
    return rebuilt_sequences(rows, 1, lambda conv: F.lit(0))


def rebuilt_sequences(rows: DataFrame, family: int, borrowed) -> DataFrame:
    """Conversations whose first turns come from the one at the head of their family of ``family`` ids.

    Conversation c takes the first ``borrowed(c)`` turns of c - c % family, or
    all of fewer, and goes on with its own turns after as many.
    """
    head = F.col("conv_id") - F.pmod("conv_id", F.lit(family))
    turns = turn_ids(rows).select(head.alias("head"), "conv_id", "turn", "id", "size", borrowed(F.col("conv_id")).cast("int").alias("take"))
    turns = turns.repartition("head").sortWithinPartitions("head", "conv_id", F.asc_nulls_first("turn"), "id")
    # a family's first rows are those of its head, if that exists; ``lent`` is what another may borrow at most
    lent = 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def families() -> Iterator[tuple]:
            of, first, now, ids, sizes, take = None, ([], []), None, [], [], 0
            for head, conv, _, i, size, k in _read(batches):
                if conv != now or head != of:
                    if now is not None:
                        yield row(of, first, now, ids, sizes, take)
                        first = (ids[:lent], sizes[:lent]) if now == of else first
                    first = first if head == of else ([], [])
                    of, now, ids, sizes, take = head, conv, [], [], k
                ids.append(i)
                sizes.append(size.to_bytes(SIZE, "little"))
            if now is not None:
                yield row(of, first, now, ids, sizes, take)

        def row(of, first, now, ids, sizes, take):
            if now == of:
                return now, b"".join(ids), b"".join(sizes)
            if take > lent:
                raise ValueError(f"at most {lent} turns can be borrowed")
            return now, b"".join(first[0][:take] + ids[take:]), b"".join(first[1][:take] + sizes[take:])

        return _write(["conv_id", "ids", "sizes"], _SEQUENCE, families())

    ship(rows.sparkSession)
    return turns.mapInArrow(run, SEQUENCE)


def blocks(sequences: DataFrame) -> DataFrame:
    """``(ids, sizes, block, n, least, members)``: equal sequences as one row per 65,536 conversation numbers."""
    block = F.shiftright("conv_id", BLOCK_BITS)
    dealt = sequences.select("ids", "sizes", "conv_id", block.alias("block")).repartition(F.xxhash64("ids", "block")).sortWithinPartitions("ids", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[tuple]:
            key, sizes, members = None, None, []
            for ids, size, conv, block in _read(batches):
                if (ids, block) != key:
                    if key:
                        yield key[0], sizes, key[1], len(members), members[0], ",".join(map(str, members))
                    key, sizes, members = (ids, block), size, []
                members.append(conv)
            if key:
                yield key[0], sizes, key[1], len(members), members[0], ",".join(map(str, members))

        return _write(["ids", "sizes", "block", "n", "least", "members"], [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()], groups())

    return dealt.mapInArrow(run, "ids binary, sizes binary, block bigint, n bigint, least bigint, members string")


def _below(key: bytes, turn: bytes) -> bytes:
    """The key of the trie node under ``key`` by the next turn."""
    return hashlib.blake2b(key + turn, digest_size=ID).digest()


def _size(sizes: bytes, depth: int) -> int:
    return int.from_bytes(sizes[SIZE * (depth - 1):SIZE * depth], "little")


def burst(rows: DataFrame, most: int) -> dict[bytes, tuple[int, bytes | None, int]]:
    """Depth, parent and last text's bytes of each head: the root, and every beginning of more than ``most`` rows."""
    heads: dict[bytes, tuple[int, bytes | None, int]] = {ROOT: (0, None, 0)}
    top = 0
    while True:
        known, reach = frozenset(heads), 2 * top + 1  # what is burst now are the heads of depth ``top``

        def run(batches: Iterator[pa.RecordBatch], known=known, top=top, reach=reach) -> Iterator[pa.RecordBatch]:
            def counts() -> Iterator[tuple]:
                seen = Counter()
                for ids, sizes in _read(batches):
                    key = ROOT
                    for depth in range(1, min(reach, len(ids) // ID) + 1):
                        above, key = key, _below(key, ids[ID * (depth - 1):ID * depth])
                        if depth > top:
                            seen[key, depth, above, _size(sizes, depth)] += 1
                        elif key not in known:
                            break
                    if len(seen) > 500_000:
                        yield from ((*k, n) for k, n in seen.items())
                        seen.clear()
                yield from ((*k, n) for k, n in seen.items())

            return _write(["key", "depth", "above", "size", "n"], [pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.int64()], counts())

        found = (rows.select("ids", "sizes").mapInArrow(run, "key binary, depth int, above binary, size bigint, n bigint")
                 .groupBy("key", "depth", "above", "size").agg(F.sum("n").alias("n")).filter(F.col("n") > most).collect())  # rows / most of a depth
        heads |= {bytes(r.key): (r.depth, bytes(r.above), r["size"]) for r in found}
        if not any(r.depth == reach for r in found):
            return heads
        top = reach


#: Rows of the sweep: nodes, and (``ended``) members that end at a head.  ``head`` is the head right above, or the head itself.
NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, head binary, ended boolean"
_NODE = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.bool_()]


class _Open:
    """A node whose subtree is being swept; ``closed`` are its children's rows, which wait for its smallest member."""

    __slots__ = ("depth", "size", "least", "n", "children", "leaves", "saved", "ends", "closed")

    def __init__(self, depth: int, size: int):
        self.depth, self.size, self.least, self.n = depth, size, None, 0
        self.children, self.leaves, self.saved, self.ends, self.closed = 0, 0, 0, NO_ENDS, []

    def add(self, least: int, n: int) -> None:
        self.least = least if self.least is None else min(self.least, least)
        self.n += n

    def close(self) -> tuple:
        self.leaves = self.leaves or 1
        self.saved += (self.n - 1) * self.size
        return self.least, self.depth, self.n, self.children, self.leaves, self.saved, self.ends

    def adopt(self, child: _Open) -> None:
        self.closed.append(child.close())
        self.add(child.least, child.n)
        self.children += 1
        self.leaves += child.leaves
        self.saved += child.saved


def _distinct(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``(container, top, head, ids, sizes, n, least, ends)`` of each sequence, its members hashed as their blocks pass."""
    now, state = None, None
    for container, top, head, ids, sizes, _, n, least, members in rows:
        if (container, top, ids) != (now and (now[0], now[1], now[3])):
            if now:
                yield (*now, state[0], state[1], state[2].hexdigest())
            now, state = (container, top, head, ids, sizes), [0, least, hashlib.sha256()]
        elif state[0]:
            state[2].update(b",")
        state[0] += n
        state[2].update(members.encode())
    if now:
        yield (*now, state[0], state[1], state[2].hexdigest())


def _sweep(rows: Iterator[tuple]) -> Iterator[tuple]:
    path: list[_Open] = []
    before, at, above = b"", None, None

    def shut(depth: int) -> Iterator[tuple]:
        """Close the open nodes deeper than ``depth``; a closed node's children know their parent now."""
        while path and path[-1].depth > depth:
            node = path.pop()
            for least, d, n, children, leaves, saved, ends in node.closed:
                yield least, d, node.least, n, children, leaves, saved, ends, None, False
            if path:
                path[-1].adopt(node)
            else:
                least, d, n, children, leaves, saved, ends = node.close()
                yield least, d, None, n, children, leaves, saved, ends, above, False

    for container, top, head, ids, sizes, n, least, ends in _distinct(rows):
        if top < 0:  # the whole sequence is a head
            yield least, None, None, n, 0, 0, 0, ends, head, True
            continue
        if container != at:
            yield from shut(-1)
            at, above, before, common = container, head, ids, top - 1
        else:
            limit, common = min(len(ids), len(before)) // ID, top
            while common < limit and ids[ID * common:ID * (common + 1)] == before[ID * common:ID * (common + 1)]:
                common += 1
            yield from shut(common)
            before = ids
        for depth in range(common + 1, len(ids) // ID + 1):
            path.append(_Open(depth, _size(sizes, depth)))
        path[-1].add(least, n)
        path[-1].ends = ends
    yield from shut(-1)


def sweep(rows: DataFrame, heads: dict) -> DataFrame:
    """The nodes below the heads and the members that end at one (``NODE``)."""
    known, names = frozenset(heads), ["container", "top", "head", *rows.columns]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def placed() -> Iterator[tuple]:
            for row in _read(batches):
                ids, key, top = row[0], ROOT, 0
                while key in known:
                    if ID * top == len(ids):
                        head, top = key, -1
                        break
                    head, key, top = key, _below(key, ids[ID * top:ID * (top + 1)]), top + 1
                yield (key, top, head, *row)

        return _write(names, [pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()], placed())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _write([c.split()[0] for c in NODE.split(", ")], _NODE, _sweep(_read(batches)))

    dealt = rows.mapInArrow(place, f"container binary, top int, head binary, {_ddl(rows)}")
    return dealt.repartition("container", "top").sortWithinPartitions("container", "top", "ids", "block").mapInArrow(run, NODE)


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)


def trie(sequences: DataFrame, least_rows: int = LEAST_ROWS, most_heads: int = HEADS) -> DataFrame:
    """The trie's nodes: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

    ``sequences`` is as ``own_sequences`` or ``rebuilt_sequences`` give it, a
    row per conversation; no row gives no node, not even a root.
    """
    spark = sequences.sparkSession
    rows = cut(blocks(sequences))
    heads = burst(rows, max(least_rows, rows.count() // most_heads))
    nodes = cut(sweep(rows, heads))
    under = nodes.filter("head is not null").groupBy("head").agg(
        F.sum("n_convs").alias("n"), F.min("conv_id").alias("least"), F.count_if(~F.col("ended")).alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max(F.when(F.col("ended"), F.col("ends_sha256"))).alias("ends")).collect()
    sums = {bytes(r.head): [r.n, r.least, r.children, r.leaves, r.saved, r.ends or NO_ENDS] for r in under}  # a row a head
    top = []
    for key in sorted(heads, key=lambda k: -heads[k][0]):  # from the deepest: each is whole when its parent adds it
        depth, above, size = heads[key]
        if key not in sums:
            continue  # the root of no conversation
        n, least, children, leaves, saved, ends = sums[key]
        leaves, saved = leaves or 1, saved + (n - 1) * size
        top.append((key, least, depth, above, n, children, leaves, saved, ends))
        if above is not None:
            into = sums.setdefault(above, [0, least, 0, 0, 0, NO_ENDS])
            sums[above] = [into[0] + n, min(into[1], least), into[2] + 1, into[3] + leaves, into[4] + saved, into[5]]
    least = {key: conv for key, conv, *_ in top}
    names = spark.createDataFrame([(bytearray(k), v) for k, v in least.items()], "head binary, head_conv bigint")
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    below = nodes.filter("not ended").join(F.broadcast(names), "head", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "head_conv"))
    return below.select(cols).unionByName(spark.createDataFrame([(c, d, least.get(a), n, k, lv, s, e) for _, c, d, a, n, k, lv, s, e in top],
                                                                 "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"))


def conversation_trie(rows: DataFrame, least_rows: int = LEAST_ROWS, most_heads: int = HEADS) -> DataFrame:
    """The contract's rows: families of five ids, c borrows crc32(c) % 9 turns.

    Null role or text is empty; a null turn comes first, equal turns by their
    ids; rows without conversation id belong to none; repeated rows are turns
    each; an empty table has no nodes; other columns are left out.
    """
    return trie(rebuilt_sequences(rows.select("conv_id", "turn", "role", "text"), 5, lambda conv: F.crc32(conv.cast("string")) % 9), least_rows, most_heads)


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


ORACLE = """
WITH t AS (SELECT conv_id, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p
    FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(x ORDER BY p) AS s FROM t GROUP BY conv_id),
steps AS (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(list_prepend(n::BIGINT, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(n))),
h AS (SELECT conv_id, s, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, z: xor(a >> 8, steps.t[(xor(a, z) & 255) + 1])), 4294967295) % 9 AS h FROM o, steps),
r AS (SELECT h.conv_id, list_concat(coalesce(b.s[1:h.h], []), h.s[h.h + 1:]) AS s FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 5),
m AS (SELECT conv_id, unnest(range(len(s) + 1)) AS d, s FROM r),
n AS (SELECT s[1:d] AS k, d, min(conv_id) AS conv_id, count(*) AS n_convs, list(conv_id ORDER BY conv_id) FILTER (len(s) = d) AS ends FROM m GROUP BY 1, 2),
u AS (SELECT n.*, p.conv_id AS parent_conv_id, CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * octet_length(encode(n.k[n.d].t)) END AS saved,
    (SELECT count(*) FROM n c WHERE c.d = n.d + 1 AND c.k[1:n.d] = n.k) AS n_children FROM n LEFT JOIN n p ON p.d = n.d - 1 AND p.k = n.k[1:n.d - 1])
SELECT u.conv_id, u.d::BIGINT AS depth, u.parent_conv_id, u.n_convs::BIGINT AS n_convs, u.n_children::BIGINT AS n_children,
    (count(*) FILTER (x.n_children = 0))::BIGINT AS n_leaves, sum(x.saved)::BIGINT AS saved_tokens, sha256(coalesce(array_to_string(any_value(u.ends), ','), '')) AS ends_sha256
FROM u JOIN u x ON x.d >= u.d AND x.k[1:u.d] = u.k GROUP BY u.conv_id, u.d, u.parent_conv_id, u.n_convs, u.n_children
"""
