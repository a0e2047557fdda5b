"""Nodes against a trie of dictionaries, with containers that are never burst, burst once and burst to the last turn."""
import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tickwise.llm import prefix_trie as P


def plain_nodes(convs):
    """``convs``: conv_id -> [(role, text), ...] -> the rows of the trie."""
    members = defaultdict(list)
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[:h[c]] + s[h[c]:] for c, s in own.items()}


def some_rows(seed, n, texts):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(3 * n), n):
        for t in range(r.choice([1, 1, 2, 3, 5, 8, 14])):
            text = None if r.random() < 0.05 else r.choice(texts[:1 + t])
            rows.append((c, None if t == 0 and c % 7 == 0 else t, None if c % 11 == 0 else ("user", "assistant")[t % 2], text))
    r.shuffle(rows)
    return rows + [(None, 1, "user", "nobody's")]


SCHEMA = "conv_id bigint, turn bigint, role string, text string, ids int, container string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4)


def cols(df):
    return sorted(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


@pytest.mark.parametrize("least, heads", [(10_000, 2048), (20, 50), (1, 1000)])
def test_against_a_trie_of_dictionaries(spark, least, heads):
    rows = some_rows(1, 150, ["Hello", "é", "", "why?", "so", "yes"])
    assert cols(P.conversation_trie(frame(spark, rows), least, heads)) == plain_nodes(plain_rebuilt(rows))


def test_a_long_common_beginning_and_many_copies(spark):
    same = [("u", f"turn {k}") for k in range(70)]
    convs = {c: list(same) for c in range(40)} | {100_000 * c: same + [("u", str(c % 3))] * (c % 4) for c in range(1, 30)}
    rows = [(c, t, role, text) for c, s in convs.items() for t, (role, text) in enumerate(s)]
    got = P.trie(P.own_sequences(frame(spark, rows)), least_rows=3, most_heads=1000)
    assert cols(got) == plain_nodes(convs)


def test_a_long_beginning_is_burst_in_few_rounds(spark):
    rows = [(c, t, "u", str(t if t < 60 else c)) for c in range(12) for t in range(62)]
    heads = P.burst(P.blocks(P.own_sequences(frame(spark, rows))), most=2)
    assert sorted(d for d, _, _ in heads.values()) == list(range(61))


def test_conversation_without_turns_and_nothing(spark):
    rows = [(c, 0, "user", "only one") for c in (7, 8, 9, 11, 12, 13, 14)]
    want = plain_rebuilt(rows)
    assert any(not s for s in want.values())
    assert cols(P.conversation_trie(frame(spark, rows))) == plain_nodes(want)
    assert P.conversation_trie(frame(spark, rows).filter("conv_id = -1")).collect() == []
