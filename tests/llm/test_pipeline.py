import re

import corpus_pipeline as C
from tests.llm.test_mixing import slow_targets
from tests.llm.test_packing import check_places
from tests.llm.test_pii import slow as slow_pii
from tests.llm.test_quality_rules import WORD, counts
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tickwise.llm import packing, pii, quality_rules

D = "/root/testdata/sf0.001"


def slow_line_fails(line):
    n = line.count(" ") + 1
    marks = sum(line.count(c) for c in "!?#*$%&|<>{}[]~^=")
    separators = sum(line.count(c) for c in "|>»•")
    ends = re.search(r"[.!?…。:;][\"'”’»)\]]*([\x20\x09-\x0D]|$)", line)
    return n > 2 and (marks > 0.25 * n or 5 * separators >= n or not ends) or n <= 20 and any(p in line.lower() for p in quality_rules.BOILERPLATE)


def slow_rules(text):
    """The cleaned text, or None if the document is rejected."""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    good = [x for x in lines if not slow_line_fails(x)]
    size = lambda ls: sum(len(w) for x in ls for w in WORD.findall(x))
    if counts(text)[-1] or size(lines) - size(good) > 0.3 * size(lines):
        return None
    return text if len(good) == len(lines) else "\n".join(good)


def slow_redact(text):
    """The base kinds only; the trees add nothing on these documents."""
    out, at = "", 0
    for a, k, b in slow_pii(text):
        if a >= at:
            out += text[at:a] + f"<{pii.KINDS[k]}>"
        at = max(at, b)
    return out + text[at:]


def test_every_stage_matches_brute_force(spark, tmp_path):
    docs, seen = spark.read.parquet(f"{D}/documents.parquet"), []
    for k, (_, stage) in enumerate(C.STAGES):
        seen.append(docs.collect())
        stage(spark, docs, D).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    seen.append(docs.collect())
    want = {r.doc_id: t for r in seen[0] if (t := slow_rules(r.text)) is not None}
    assert {r.doc_id: r.text for r in seen[1]} == want and all(r.n_chars == len(r.text) for r in seen[1])
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in seen[1]]
    assert sorted(r.doc_id for r in seen[2]) == sorted(set(slow_components(rows)))
    assert {r.doc_id: r.text for r in seen[3]} == {r.doc_id: slow_redact(r.text) for r in seen[2]}
    size, taken = {}, {}
    for r in seen[3]:
        size[r.source] = size.get(r.source, 0) + len(WORD.findall(r.text))
    copies = [r.doc_id for r in seen[4]]
    assert max(map(copies.count, copies)) <= 2 and set(copies) <= {r.doc_id for r in seen[3]}
    for r in seen[4]:
        taken[r.source] = taken.get(r.source, 0) + len(WORD.findall(r.text))
    for s, goal in slow_targets(size).items():
        assert abs(taken.get(s, 0) - goal) <= max(len(WORD.findall(r.text)) for r in seen[3] if r.source == s)
    tokens = packing.WordTokenizer(packing.tokenizer_path()).encode([r.text for r in seen[4]])
    assert sum(r.length for r in seen[5]) == sum(len(t) // 4 + 1 for t in tokens)
    assert check_places(seen[5]) <= sum(r.length for r in seen[5]) / 4096 + 2


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(C.STAGES):
        docs = stage(spark, docs, D)
        docs.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(docs.count())
        assert docs.columns == columns or k == len(C.STAGES) - 1
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    ids = [{r.doc_id for r in spark.read.parquet(str(tmp_path / str(k))).select("doc_id").collect()} for k in range(5)]
    assert ids[4] == ids[3] <= ids[2] == ids[1] <= ids[0]
    whole = C.run(spark, D)
    assert whole.count() == sizes[-1]


def test_registered():
    import __spark_entry__ as E

    names = E.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
