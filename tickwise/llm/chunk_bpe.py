"""Byte-pair encoding that reuses content-defined chunks, and decoding.

A rolling hash over the last 16 bytes cuts a text into chunks, so equal
passages of different documents become equal chunks whatever stands before
them.  A task encodes a distinct chunk once and takes it from its memory for
every other document.  Where two chunks join, the tokens near the cut may be
wrong; they are encoded again from the last place whose pre-token can't depend
on what follows, until the scan meets a place where the right chunk begins a
pre-token too: the pre-tokenizer never looks back, so both agree from there on.

Scale: documents meet in a task by their smallest chunk hash, so copies and
near copies do, in one shuffle of the texts.  A group of more bytes than its
share is dealt over several tasks; each of them encodes the group's chunks
again.  Memory is bounded by the chunk and word caches and one batch of texts.
"""
from __future__ import annotations

import hashlib
import json
import re
import struct
from array import array
from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import map_rows, ship, table, whole_text

MEAN_CHUNK, LEAST_CHUNK, MOST_CHUNK = 1024, 256, 8192
#: Most entries of a worker's caches, and longest pre-token kept.
CACHE_CHUNKS, CACHE_WORDS, CACHE_CHARS = 8192, 900_000, 48
#: Bytes of text a task should get, and the most groups that may be split (a group is split above 1/SPLIT of all bytes).
TASK_BYTES, SPLIT = 64 << 20, 4096

# The letters, digits and marks below are such in every version of Unicode since 6.0, so the
# scan below cuts texts made of them as the vocabulary's own pattern does; other texts go through the library.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ʯЀ-ҁ"
_DIGITS = "0-9²³¹¼-¾"
_SPACES = "\\t\\n\\r\\x20"
_MARKS = "!-/:-@\\[-`{-~¡-©«¬®-±´¶-¸»¿×÷‐-‧€"
_KNOWN = re.compile(f"[{_LETTERS}{_DIGITS}{_SPACES}{_MARKS}]*")
_SCAN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[{_MARKS}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+")
#: A pre-token is settled if its end lies before the end of what was scanned, and so do the characters that a contraction looks at.
_LOOK = 3


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The vocabulary's letter for each byte: the byte's own character if it is printable, else the next free one from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_TABLE = np.random.default_rng(7).integers(0, 2**32, 256, dtype=np.uint32)


def cuts(data: np.ndarray, offsets: np.ndarray, mean: int = MEAN_CHUNK, least: int = LEAST_CHUNK, most: int = MOST_CHUNK) -> list[list[int]]:
    """Per text (bytes ``offsets[i]`` to ``offsets[i+1]`` of ``data``) the ends of its chunks, on character borders."""
    if most < 4:
        raise ValueError("a chunk must hold a character of four bytes")
    with np.errstate(over="ignore"):
        h, m, step = _TABLE[data], np.uint32(0x9E3779B1), 1
        while step < 16:  # the hash of the last 2, 4, 8, 16 bytes
            longer = h.copy()
            longer[step:] += m * h[:-step] if len(h) > step else 0
            h, m, step = longer, m * m, step * 2
    border = np.ones(len(data) + 1, bool)
    border[:-1] = (data & 0xC0) != 0x80
    marks = np.flatnonzero(h < np.uint32(2**32 // mean)) + 1
    marks = marks[border[marks]]
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        ends, at = [], a
        for p in marks[np.searchsorted(marks, a + least):np.searchsorted(marks, b)].tolist() + [b]:
            while p - at > most:  # no mark for long: the chunk ends at the most bytes, back at a character's border
                at += most
                while not border[at]:
                    at -= 1
                ends.append(at)
            if p - at >= least or p == b:
                ends.append(p)
                at = p
        out.append(ends if b > a else [])
    return out


class _Words(dict):
    """Ids of the pre-tokens met so far; a new one is encoded when it is looked up."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece)
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[piece] = ids
        return ids


class ChunkTokenizer:
    """Ids of texts by chunks, exactly as the whole tokenizer gives them, and the bytes of ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        spec = json.loads(whole.to_str())
        ways = spec["pre_tokenizer"] or {}
        if ways.get("type") != "ByteLevel" or ways.get("add_prefix_space") or not ways.get("use_regex", True) or spec["normalizer"] or spec["model"].get("dropout"):
            raise ValueError("only byte-level vocabularies without prefix space, normalizer and dropout")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip their neighbours aren't supported")
        self.model, self.library, self.letters = whole.model, whole.pre_tokenizer, _byte_letters()
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in spec["added_tokens"]}
        self.apart = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.chunks, self.encoded = OrderedDict(), 0
        self.word = _Words(self._new_word).__getitem__
        byte = {c: b for b, c in self.letters.items()}
        names = whole.get_vocab(with_added_tokens=True)
        parts = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            parts[i] = bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()
        self.parts = pa.array(parts, pa.large_binary())

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text that stands alone."""
        if _KNOWN.fullmatch(text):
            return _SCAN.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def _new_word(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def chunk(self, text: str) -> tuple[bytes, array]:
        """Ids of a chunk and the characters where its pre-tokens begin; from memory if it was met."""
        got = self.chunks.get(text)
        if got is not None:
            self.chunks.move_to_end(text)
            return got
        pieces = self.pieces(text)
        got = self.chunks[text] = (b"".join(map(self.word, pieces)), array("q", accumulate(map(len, pieces), initial=0)))
        self.encoded += 1
        if len(self.chunks) > CACHE_CHUNKS:
            self.chunks.popitem(last=False)
        return got

    def span(self, text: str, first: int, last: int) -> bytes:
        """The chunk's ids of its pre-tokens ``first`` to ``last``, which lie near its ends."""
        ids, starts = self.chunk(text)
        size = lambda a, b: sum(len(self.word(text[starts[i]:starts[i + 1]])) for i in range(a, b))
        return ids[size(0, first):len(ids) - size(last, len(starts) - 1)]

    @staticmethod
    def settled(starts: list[int] | array, end: int) -> int:
        """How many pre-tokens can't depend on what follows the ``end`` of the scanned text."""
        n = len(starts) - 1
        while n and (starts[n] >= end or starts[n - 1] + _LOOK > end):
            n -= 1
        return n

    def join(self, chunks: list[str]) -> bytes:
        """Ids of the chunks' whole text."""
        out, k, first = [], 0, 0  # the next pre-token is number ``first`` of chunk ``k``
        while True:
            starts = self.chunk(chunks[k])[1]
            if k == len(chunks) - 1:
                out.append(self.span(chunks[k], first, len(starts) - 1))
                return b"".join(out)
            last = max(self.settled(starts[-32:], starts[-1]) + max(0, len(starts) - 32), first)
            out.append(self.span(chunks[k], first, last))
            # scan on from there, over the join, until the right chunk's own pre-tokens begin at a settled place
            rest, k = chunks[k][starts[last]:], k + 1
            border, window = len(rest), 64
            right = self.chunk(chunks[k])[1]
            while True:
                more = chunks[k][:window]
                found = self.pieces(rest + more)
                ends = [*accumulate(map(len, found), initial=0)]
                whole = window >= len(chunks[k])
                sure = len(found) if whole and k == len(chunks) - 1 else self.settled(ends, len(rest) + len(more))
                at = next((n for n in range(sure + 1) if ends[n] >= border and (j := bisect_left(right, ends[n] - border)) < len(right) and right[j] == ends[n] - border), None)
                if at is not None:
                    out.extend(map(self.word, found[:at]))
                    first = j
                    break
                if not whole:
                    window *= 2
                    continue
                if k == len(chunks) - 1:
                    out.extend(map(self.word, found))
                    return b"".join(out)
                # the chunk ended without agreement: what is settled goes out, the rest meets the next chunk
                out.extend(map(self.word, found[:sure]))
                rest, k, window = (rest + more)[ends[sure]:], k + 1, 64
                border, right = len(rest), self.chunk(chunks[k])[1]

    def encode(self, chunks: list[str]) -> bytes:
        """Ids, as little-endian 32-bit words, of a text in chunks; added tokens in it stand apart."""
        if not chunks:
            return b""
        if not self.apart or not self.apart.search("".join(chunks)):
            return self.join(chunks)
        out, run = [], []
        at, spans = 0, [(m.start(), m.end(), m.group()) for m in self.apart.finditer("".join(chunks))] + [(1 << 60, 1 << 60, None)]
        for c in chunks:  # chunks are cut again where an added token begins or ends
            end = at + len(c)
            while c:
                a, b, name = spans[0]
                if at < a:
                    run.append(c[:a - at])
                    at, c = min(a, end), c[a - at:]
                else:
                    if run:
                        out.append(self.join(run))
                        run = []
                    at, c = min(b, end), c[b - at:]
                    if at == b:
                        out.append(self.added[name])
                        spans.pop(0)
        if run:
            out.append(self.join(run))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 bytes of the ids' text; bytes that are no characters become U+FFFD."""
        taken = self.parts.take(pa.array(np.frombuffer(ids, "<u4")))
        if not len(taken):
            return b""
        data = taken.buffers()[2].to_pybytes()
        return data.decode("utf-8", "replace").encode()


_TOKENIZERS: dict[str, ChunkTokenizer] = {}


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def _home(data: bytes, ends: list[int], a: int) -> int:
    """The smallest chunk hash of a text, below 2^63; an empty text's is 0."""
    return min((xxhash.xxh64_intdigest(data[p:q]) >> 1 for p, q in zip([a, *ends], ends)), default=0)


def homes(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs``' ``keep`` columns and text with ``home``, the smallest chunk hash, and ``bytes``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(*keep, whole_text(text_col).alias("text"))
    ship(rows.sparkSession)
    shape = rows.withColumns({"home": F.lit(0).cast("bigint"), "bytes": F.lit(0).cast("bigint")}).schema
    arrow = to_arrow_schema(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                data, offsets = _texts(part.column(part.num_columns - 1))
                raw = data.tobytes()
                found = [_home(raw, ends, a) for ends, a in zip(cuts(data, offsets), offsets.tolist())]
                cols = [*part.columns, pa.array(found, pa.int64()), pa.array(np.diff(offsets), pa.int64())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return rows.mapInArrow(run, shape)


def gather(docs: DataFrame, task_bytes: int = TASK_BYTES, split: int = SPLIT) -> DataFrame:
    """``(doc_id, text)`` with texts of one home in one task, unless the home holds over ``1/split`` of all bytes and a task's share."""
    spark = docs.sparkSession
    sizes = homes(docs).groupBy("home").agg(F.sum("bytes").alias("bytes"))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    share = max(total // split, min(task_bytes, -(-total // tasks)))
    # at most ``split`` homes can hold more than that each
    hot = {r.home: -(-r.bytes // share) for r in sizes.filter(F.col("bytes") > share).collect()}
    parts = spark.createDataFrame([(k, int(v)) for k, v in hot.items()], "home bigint, parts int")
    rows = homes(docs, keep=("doc_id",)).join(F.broadcast(parts), "home", "left")
    deal = F.pmod(F.xxhash64("doc_id", "bytes", F.spark_partition_id()), F.coalesce("parts", F.lit(1)))
    return rows.select("doc_id", "text", F.pmod(F.xxhash64("home") + deal, F.lit(tasks)).cast("int").alias("task")).repartitionById(tasks, F.col("task")).drop("task")


def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded])``: a row per document.

    Null text is empty and has no tokens; a null id stays null; repeated rows
    are encoded each; an empty table gives no rows; other columns are left out.
    Strings of the vocabulary's added tokens become those tokens, as in the
    library.  ``ids`` holds little-endian unsigned 32-bit integers.
    """
    path = path or tokenizer_path()
    rows = gather(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * with_ids

    def run(cols):
        model = _TOKENIZERS.get(path) or _TOKENIZERS.setdefault(path, ChunkTokenizer(path))
        data, offsets = _texts(pa.array(cols[1], pa.large_string()))
        raw, out = data.tobytes(), []
        for doc, ends, a in zip(cols[0], cuts(data, offsets), offsets.tolist()):
            ids = model.encode([raw[p:q].decode() for p, q in zip([a, *ends], ends)])
            back = model.decode(ids)
            out.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()) + (ids, back.decode()) * with_ids)
        return [list(c) for c in zip(*out)]

    return map_rows(rows, schema, run)


def op13_chunk_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
