import re

from tickwise.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LINES = [
    "Released under the MIT License. Again: UNDER THE MIT LICENSE, under  the mit-license", "Apache License, Version 2.0 and apache license version 2", "CC BY-NC 4.0; cc by nc by nc", "under the mit", "Ünder the mit licensé under the mit license",
    "Kelvin K under the MIT License", "cc\x7fby{nc}", "x" * 9000 + " under the MIT License " * 50,
]


def slow(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for label, p in L.PHRASES for i in range(len(words)) if tuple(words[i:i + len(p)]) == p]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_columns_match_brute_force(spark, docs, nothing):
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, x) for i, x in enumerate(LINES)], "doc_id bigint, text string"))
    got = L.scan(df).collect()
    assert len(got) == df.count() and L.scan(nothing).count() == 0
    assert sorted((str(r.doc_id), str((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))) for r in got) == sorted((str(r.doc_id), str(slow(r.text))) for r in df.collect())
    for r in got:
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1 and r.labels == ",".join(sorted(set(r.labels.split(","))))


def test_method_finds_changed_and_moved_templates(spark):
    from tests.llm.conftest import unlike

    mit = dict(L.TEMPLATES)["mit"]
    words = mit.split()
    changed = " ".join(words[:20] + ["really"] + words[20:40] + words[42:])
    rows = [(1, f"{unlike(1, 80)} {mit} {unlike(2, 40)}"), (2, f"{unlike(3, 80)} {changed}"), (3, unlike(4, 200)), (4, "under the terms of the agreement and the software shall be free of charge"),
            (5, "This work is licensed under the GNU General Public License, version 3."), (6, unlike(6, 10) + " " + " ".join(words[:12]))]
    got = {r.doc_id: r for r in L.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1].labels == got[2].labels == "mit" and got[1].n_base == 0
    assert got[1].score == 1.0 and 0.8 <= got[2].score < 1.0
    assert got[1].places.startswith("mit:80:") and got[3].labels == got[4].labels == got[6].labels == "" and got[3].score == 0.0
    assert got[5].labels == "gpl-3"


def test_each_notice_has_its_own_label_only(spark):
    from tests.llm.conftest import unlike

    rows = [(i, f"{unlike(i, 30)} {text} {unlike(i + 100, 30)}") for i, (_, text) in enumerate(L.TEMPLATES)]
    rows += [(100, "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.")]
    found = L.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    got = {r.doc_id: {p.split(":")[0] for p in r.places.split(",")} for r in found}  # the method's own; the phrase of cc-by-nc also stands in its relatives' identifiers
    assert got.pop(100) == {"cc-by-nd"} and got == {i: {label} for i, (label, _) in enumerate(L.TEMPLATES)}
    assert all(set(r.labels.split(",")) == got.get(r.doc_id, {"cc-by-nd"}) | set(filter(None, r.base_labels.split(","))) for r in found)


def test_a_relative_is_never_read_as_another_license(spark):
    affero = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    rows = [
        (1, "Except where noted, licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License, see the site", "cc-by-nc-sa"),
        (2, "All photos are licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "cc-by-nc-nd"),
        (3, affero, "agpl"), (4, affero.replace("Affero ", ""), "gpl-3"), (5, affero.replace("Affero ", "").replace("version 3", "version 2"), "gpl-2"),
        # nothing says which version: no label rather than a wrong one
        (6, "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", ""),
        # 8: the phrase cc by nc is a base label wherever it stands
        (7, "# SPDX-License-Identifier: MIT\nimport os", "mit"), (8, "// SPDX-License-Identifier: CC-BY-NC-SA-4.0", "cc-by-nc,cc-by-nc-sa"), (9, "Distributed under the Boost Software License, Version 1.0.", "boost"),
    ]
    got = {r.doc_id: r.labels for r in L.scan(spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")).collect()}
    assert got == {i: label for i, _, label in rows}


def test_windows_left_out_hold_a_word_of_no_template(spark):
    from tests.llm.conftest import unlike

    text = f"{unlike(1, 50)} Released under the MIT License by the author of this software {unlike(2, 50)} to the terms of the"
    rows = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "under the")], "doc_id bigint, text string").withColumn("words", L.words_of(L.F.col("text"))).drop("text")
    every = {tuple(r) for r in L._exploded(rows, L.K).collect()}
    some = {tuple(r) for r in L._exploded(rows, L.K, L.template_words()).collect()}
    known = {(r.g, r.word) for r in L.template_windows(spark).collect()}
    joined = lambda found: {r for r in found if (r[2], r[3]) in known}
    assert joined(every) == joined(some) and joined(some) and len(some) < len(every)


def test_chained_copies_are_taken_apart(spark):
    line = "Copyright. All rights reserved."
    rows = [(n, "\n".join([line] * n)) for n in (1, 2, 3, 7, 500)] + [(1000, "\n".join([line] * 4 + ["This work is licensed under a Creative Commons Attribution 4.0 International License."] + [line] * 3))]
    got = {r.doc_id: r for r in L.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(got[n].labels == "all-rights-reserved" and got[n].score == 1.0 for n in (1, 2, 3, 7, 500))
    assert got[3].places == ",".join(f"all-rights-reserved:{4 * i}:{4 * i + 4}" for i in range(3)) and len(got[500].places.split(",")) == 500
    assert got[1000].labels == "all-rights-reserved,cc-by"
