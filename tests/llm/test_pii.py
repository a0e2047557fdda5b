import hashlib
import random
import re

from tickwise.llm import pii as P


def luhn(d):
    total = 0
    for i, x in enumerate(reversed(d)):
        x = int(x) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


PLAIN = [
    (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m.split("."))),
    (re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(digits(m)) <= 15),
]
LINES = [
    "a@b.c_d@e.f", "x@y", "é john.doe+x@mail.example.com, ok", "1.2.3.4.5.6.7.8 and 256.1.1.1 and 001.02.3.255", "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111.", "+1 (743) 555-3824 x +12 3 +1555", "+1+22 333 444 5555",
    "\U0001F600 +49 30 1234567 a@b.co \U0001F600 10.0.0.1", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2", "@@a@@b.c", "a@b..c a@b.c.", "5  5", "a@b.c" * 30, "7" * 30_000, "a" * 30_000 + "@x.y",
]


def slow(text):
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(PLAIN) for m in p.finditer(text or "") if ok(m[0]))


def write(spans):
    return ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_base_columns_match_plain_patterns(spark, docs, nothing):
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, x) for i, x in enumerate(LINES)], "doc_id bigint, text string"))
    got = P.find(df).collect()
    assert len(got) == df.count() and P.find(nothing).count() == 0
    want = sorted((str(r.doc_id), *[sum(k == j for _, k, _ in slow(r.text)) for j in range(4)], hashlib.sha256(write(slow(r.text)).encode()).hexdigest()) for r in df.collect())
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    for r in got:
        kinds = [s.split(":")[0] for s in r.spans.split(",") if s]
        assert sum(k in P.BASE_KINDS for k in kinds) == r.n_email + r.n_ip + r.n_card + r.n_phone


def card(r, good):
    d = [r.randrange(10) for _ in range(15)]
    last = next(x for x in range(10) if luhn("".join(map(str, d)) + str(x)))
    return "".join(map(str, d)) + str(last if good else (last + 3) % 10)


def samples(n, seed):
    r = random.Random(seed)
    phone = lambda: f"+1 ({r.randrange(200, 999)}) {r.randrange(200, 999)}-{r.randrange(1000, 9999)}"
    rows = []
    for i in range(n):
        rows.append((i, r.choice([
            f"please call {phone()} today", f"card {card(r, True)} was used", f"order no {card(r, False)[:12]}x", f"version {r.randrange(300, 999)}.{r.randrange(9)}.{r.randrange(9)}.1 is out",
            f"host 10.{r.randrange(255)}.{r.randrange(255)}.7", f"mail user{i}@example.com", "nothing to see", f"size 12{r.randrange(9)} by {r.randrange(9)}",
        ])))
    return rows


def test_trees_learn_and_calibrate(spark):
    df = spark.createDataFrame(samples(800, 1), "doc_id bigint, text string")
    model = P.fit(df)
    assert model.trees and model.threshold is not None
    rows = [r.asDict() for r in P.training_table(spark.createDataFrame(samples(800, 2), "doc_id bigint, text string")).collect()]
    above = [(r["good"], r["bad"]) for r in rows if model.score(r) >= model.threshold]
    good, bad = sum(g for g, _ in above), sum(b for _, b in above)
    assert good >= 0.9 * (good + bad) and good > 100
    assert len(rows) < 200


def test_expression_equals_the_trees(spark):
    from pyspark.sql import functions as F

    model = P.fit(spark.createDataFrame(samples(400, 3), "doc_id bigint, text string"))
    rows = [r.asDict() for r in P.training_table(spark.createDataFrame(samples(200, 4), "doc_id bigint, text string")).collect()]
    got = spark.createDataFrame(rows).withColumn("s", model.column({k: F.col(k) for k in P.FEATURES})).collect()
    assert all(abs(r.s - model.score(r.asDict())) < 1e-9 for r in got)


def test_added_spans_come_from_the_trees_and_clean_text_stays(spark):
    model = P.fit(spark.createDataFrame(samples(800, 1), "doc_id bigint, text string"))
    rows = [(1, "please call (743) 555-3824 today"), (2, "a clean text of words only"), (3, "from 1999 to 2004, pages 12-19"), (4, "mail jo@x.org or 10.0.0.1")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in P.find(df, model=model).collect()}
    assert got[2] == got[3] == "" and got[4] == "email:5:13,ip:17:25"
    out = {r.doc_id: r.text for r in P.redact(df, model=model).collect()}
    assert out[2] == rows[1][1] and out[3] == rows[2][1] and out[4] == "mail <email> or <ip>"
    assert "555" not in out[1] or got[1] == ""


def test_redact_merges_overlaps_and_keeps_columns(spark, docs, nothing):
    number = next(x for x in map(str, range(411111111111110, 411111111111199)) if luhn(x))  # a phone number and a card at once
    df = spark.createDataFrame([(1, f"x +{number} y a@b.co z", 5)], "doc_id bigint, text string, n_chars int")
    assert P.find(df).collect()[0].spans == "phone:2:18,card:3:18,email:21:27"
    row = P.redact(df).collect()[0]
    assert row.text == "x <phone> y <email> z" and row.n_chars == len(row.text)
    out = P.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count() and P.redact(nothing).count() == 0


def test_ibans_of_any_length_and_accounts_before_a_full_stop(spark):
    ibans = ["DE89370400440532013000", "GB82WEST12345698765432", "FR1420041010050500013M02606", "NO9386011117947", "MU17BOMM0101101030300200000MUR", "SC18SSCB11010000000000001497USD"]
    ibans += [" ".join(x[i:i + 4] for i in range(0, len(x), 4)) for x in ibans]
    texts = [f"iban {x}{end}" for x in ibans for end in ("", ".", " AND SO on", ", then")] + ["account 12345678.", "account 12345678", "account 12345678. Next"]
    model = P.Boosted([])
    model.threshold = -1e9  # takes every candidate
    got = {r.doc_id: r.text for r in P.redact(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model=model).collect()}
    want = [f"iban <iban>{end}" for _ in ibans for end in ("", ".", " AND SO on", ", then")] + ["account <account>.", "account <account>", "account <account>. Next"]
    assert [got[i] for i in range(len(texts))] == want
    none = spark.createDataFrame([(1, "version 12345678.5 of AB12 3456 7890")], "doc_id bigint, text string")
    found = P.candidates(none.select("text")).selectExpr("filter(__found, c -> c.kind > 4) f").collect()[0].f
    assert [c for c in found if P.KINDS[c.kind] in ("iban", "account")] == []
