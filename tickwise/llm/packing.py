"""Vector best-fit packing of tokenised documents into sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum
of squared piece lengths).  Pieces come in falling length; each goes to the
open sequence that can take it under every capacity and fits best, either by
the largest weighted dot product of the piece with the residual capacities or
by the smallest weighted norm of what would remain.

Scale: only digests of pieces are shuffled, never tokens.  Pieces that fill a
sequence alone skip the search.  The others are dealt by hash into groups of
about ``group_pieces`` pieces, however many documents there are, and groups
are packed independently; a group leaves at most a few unfilled sequences.
"""
from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import cut, map_rows, ship, table, whole_text

SEQUENCE_TOKENS = 4096
#: No piece set of 4096 tokens can exceed either, so tokens decide; smaller values bind.
SEQUENCE_DOCUMENTS = 4096
SEQUENCE_ATTENTION = SEQUENCE_TOKENS ** 2
WEIGHTS = (1.0, 0.01, 0.1)
GROUP_PIECES = 16_384
END_ID = 1
#: Most entries of a worker's word cache, and longest word kept in it.
CACHE_WORDS, CACHE_CHARS = 900_000, 48


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: A Latin word and the ASCII marks after it: two pre-tokens whatever stands beside them.
_WORD_AND_MARKS = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([.,!?*#$%&|;:]*)")


def _byte_letters() -> dict[int, str]:
    """The vocabulary's letter for each byte: the byte's own character if it is printable, else the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Words(dict):
    """The ids of each word met so far; a new word is encoded when it is first looked up."""

    def __init__(self, encode):
        super().__init__({"": b""})
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= CACHE_CHARS:
            self[word] = ids
        return ids


class WordTokenizer:
    """Token ids of a text as little-endian 32-bit words.

    The vocabulary drops white space and never joins over it, so a text's ids
    are those of its space-separated parts in order; parts recur, and are
    kept.  A Latin word with marks after it goes to the model by its two
    pre-tokens, everything else through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole, self.letters = Tokenizer.from_file(path), _byte_letters()
        self.model, self.words, self.marks = self.whole.model, _Words(self._new), _Words(self._all)

    def _all(self, text: str) -> bytes:
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _new(self, word: str) -> bytes:
        latin = _WORD_AND_MARKS.fullmatch(word)
        if not latin:
            return self._all(word)
        core, marks = latin.groups()
        core = core.lower()
        if not core.isascii():
            core = core.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(core)]
        return struct.pack(f"<{len(ids)}I", *ids) + self.marks[marks]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) + len(self.marks) > CACHE_WORDS:
            self.words.clear()
            self.marks.clear()
        look = self.words.__getitem__
        return [b"".join(map(look, t.replace("\n", " ").split(" "))) for t in texts]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def pieces(docs: DataFrame, path: str, max_tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: a row per piece; only longer documents are cut."""
    end = np.array([end_id], "<u4").tobytes()
    out = ["doc_id bigint", "piece int", "start bigint", "length bigint", "ids_crc32 bigint"] + ["ids binary"] * with_ids

    def run(cols):
        model = _TOKENIZERS.get(path) or _TOKENIZERS.setdefault(path, WordTokenizer(path))
        rows = []
        for doc, ids in zip(cols[0], model.encode(cols[1])):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * max_tokens)):
                part = ids[at:at + 4 * max_tokens]
                rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part)[:len(out)])
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in out]

    return map_rows(docs.select(F.col(id_col).cast("bigint"), whole_text(text_col)), ", ".join(out), run)


def best_fit(lengths: np.ndarray, caps: tuple[int, int, int], weights: tuple[float, float, float], rule: str) -> np.ndarray:
    """The bin of each length, which must be in falling order and below every capacity."""
    cap = np.asarray(caps, float)
    room, names = np.empty((64, 3)), np.empty(64, np.int64)  # open bins, as shares of the capacities
    n, used, out = 0, 0, np.empty(len(lengths), np.int64)
    least = np.array([lengths[-1], 1, lengths[-1] ** 2], float) / cap if len(lengths) else None
    w, eps = np.asarray(weights), 1e-9
    for k, size in enumerate(lengths.tolist()):
        need = np.array([size, 1, size * size], float) / cap
        fits = np.flatnonzero((room[:n] + eps >= need).all(axis=1))
        if len(fits):
            if rule == "dot":
                # of equal products the fullest sequence: residuals are judged against what a fuller one would waste
                score = ((1 - room[fits]) * need * w).sum(axis=1)
                at = fits[np.argmax(score)]
            else:
                at = fits[np.argmin((w * (room[fits] - need) ** 2).sum(axis=1))]
        else:
            if n == len(room):
                room, names = np.concatenate([room, np.empty_like(room)]), np.concatenate([names, np.empty_like(names)])
            room[n], names[n], at = 1.0, used, n
            n, used = n + 1, used + 1
        room[at] -= need
        out[k] = names[at]
        if (room[at] + eps < least).any():  # nothing that is left can go there
            n -= 1
            room[at], names[at] = room[n], names[n]
    return out


def pack(rows: DataFrame, max_tokens: int = SEQUENCE_TOKENS, max_documents: int = SEQUENCE_DOCUMENTS, max_attention: int = SEQUENCE_ATTENTION, weights: tuple = WEIGHTS, rule: str = "norm", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``rows`` (of ``pieces``, without ids) with ``sequence_id`` and the gapless ``offset`` in it.

    Every piece must fit a sequence alone: lengths are at most ``max_tokens``
    and their squares at most ``max_attention``.
    """
    if rule not in ("dot", "norm"):
        raise ValueError(f"rule is dot or norm, not {rule!r}")
    caps = (max_tokens, max_documents, max_attention)
    ship(rows.sparkSession)
    rows = cut(rows)
    alone = F.col("length") == max_tokens
    total = rows.filter(~alone).count()
    groups = max(1, -(-total // group_pieces))
    key = F.struct("doc_id", "piece", "ids_crc32")
    dealt = rows.filter(~alone).withColumn("g", F.pmod(F.xxhash64(key), F.lit(groups)).cast("int"))
    stride = 1 << 40  # sequence numbers of a group are group * stride + its own numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names = [], None
        for batch in batches:
            names = batch.schema.names
            held.append(batch)
        if not held:
            return
        whole = pa.Table.from_batches(held).combine_chunks()
        order = np.lexsort((whole["piece"].to_numpy(), whole["ids_crc32"].to_numpy(), whole["doc_id"].fill_null(-1).to_numpy(), -whole["length"].to_numpy(), whole["g"].to_numpy()))
        whole = whole.take(pa.array(order))
        group, length = whole["g"].to_numpy(), whole["length"].to_numpy()
        seq, offset = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
        for a, b in zip(*_runs(group)):
            bins = best_fit(length[a:b], caps, weights, rule)
            seq[a:b] = group[a].astype(np.int64) * stride + bins
            by = np.argsort(bins, kind="stable")
            before = np.cumsum(length[a:b][by]) - length[a:b][by]
            first = np.concatenate([[True], bins[by][1:] != bins[by][:-1]])
            offset[a + by] = before - np.maximum.accumulate(np.where(first, before, 0))
        table_ = whole.drop_columns(["g"]).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(offset))
        yield from table_.to_batches(max_chunksize=65536)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    # the group's number is the partition's: one group a task, whatever their hashes
    packed = dealt.select(*rows.columns, "g").repartitionById(groups, F.col("g")).mapInArrow(run, schema)
    # a full piece is a sequence by itself: numbered below zero, apart from the groups' numbers
    full = rows.filter(alone).select(*rows.columns, (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return packed.unionByName(full)


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return edge.tolist(), [*edge[1:].tolist(), len(values)]


def pack_documents(docs: DataFrame, path: str | None = None, max_tokens: int = SEQUENCE_TOKENS, **limits) -> DataFrame:
    """The contract's rows: a row per piece with its place.

    Null text is empty, so its document is the end id alone; a null id stays
    null; repeated rows are packed each; an empty table gives no rows.
    """
    return pack(pieces(docs, path or tokenizer_path(), max_tokens), max_tokens, **limits)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
