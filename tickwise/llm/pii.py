"""Personal data by candidate gradient boosting, in DataFrame functions only.

High-recall generators propose spans of many kinds; strict checks decide the
base kinds (email, ip, card, phone).  The other candidates are judged by
boosted trees over binned format and context features.  The trees learn from
all candidates whose kind has a check: what passes it is personal, what fails
is not, and the features leave the check's own result out, so that format and
context carry over to the kinds without one.

Scale: training sees a table of feature vectors with counts, a partial
aggregate over all documents whose rows are bounded by the product of the
bins, never by the corpus.  Boosting and calibration run on that table.  The
trees are then one SQL expression, and every span is found, scored and
written inside the row: no shuffle, no join back.
"""
from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import table, whole_text

BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds that only the trees can accept.
MORE_KINDS = ("masked_email", "local_phone", "national_id", "iban", "account")
KINDS = BASE_KINDS + MORE_KINDS
#: Kinds whose strict check labels them for training.
LABELLED = ("email", "ip", "card", "phone")

#: Possessive repeats and look-behinds find what plain greedy ones find, in linear time and without recursion.
GENERATORS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "masked_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}\x20?(?:\.|[\[(](?:dot|DOT)[\])])\x20?[A-Za-z]{2,24}",
    "local_phone": r"(?<![0-9.+()-])(?<![0-9+)][\x20])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9]|[.-][0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    # 15 to 34 characters, the last group of any length; behind a space it holds a digit, but in the two countries that end in a currency
    "iban": r"(?<![A-Za-z0-9])(?:(?:MU|SC)[0-9]{2}(?:\x20?[A-Z0-9]{4}){6}\x20?[A-Z]{2,3}|[A-Z]{2}[0-9]{2}(?:(?:\x20?[A-Z0-9]{4}){3,7}(?:(?:\x20(?=[A-Z]{0,3}[0-9]))?[A-Z0-9]{1,4})?|(?:\x20?[A-Z0-9]{4}){2}\x20?[A-Z0-9]{3}))(?![A-Za-z0-9])",
    "account": r"(?<![0-9A-Za-z.+-])[0-9]{8,20}(?![0-9A-Za-z-]|\.[0-9])",
}
#: What a text must hold for a generator to run: most texts skip most of them.
GATES = {"email": "@", "phone": "+", "masked_email": r"[\[(](?:at|AT)[\])]"}
#: Words before a span that speak for personal data.
HINTS = ("call", "phone", "tel", "mobile", "fax", "mail", "contact", "card", "visa", "credit", "account", "iban", "ssn", "passport", "number", "host", "ip")
CONTEXT = 24

#: Features of a candidate and the number of values each can take; their product bounds the training table.
FEATURES = {"digits": 7, "marks": 4, "letters": 3, "groups": 4, "hint": 2, "left": 3, "right": 3, "varied": 3, "plus": 2, "at": 2}

ROUNDS, RATE, DEPTH = 40, 0.3, 2
#: Least precision that the calibrated threshold must show on the held-out part, and the least support for one.
PRECISION, SUPPORT = 0.95, 20
HELD_OUT = 5


def _found(text: Column, kind: str) -> Column:
    """Array of ``(start, end, kind, match)`` for a generator's leftmost non-overlapping matches, in code points."""
    pattern = F.lit(GENERATORS[kind])
    both = F.struct(F.regexp_extract_all(text, F.concat(F.lit("("), pattern, F.lit(")")), F.lit(1)).alias("m"), F.split(text, pattern, -1).alias("gaps"))
    number = F.lit(KINDS.index(kind))

    def spans(b: Column) -> Column:
        # a match starts where the gaps and matches before it end
        ends = F.aggregate(
            F.sequence(F.lit(0), F.size(b["m"]) - 1), F.array(F.lit(0)),
            lambda acc, i: F.concat(acc, F.array(F.get(acc, i) + F.length(F.get(b["gaps"], i)) + F.length(F.get(b["m"], i)))),
        )
        return F.get(F.transform(F.array(F.struct(b["m"].alias("m"), ends.alias("e"))), lambda x: F.transform(
            x["m"], lambda m, i: F.struct((F.get(x["e"], i + 1) - F.length(m)).alias("start"), F.get(x["e"], i + 1).alias("end"), number.alias("kind"), m.alias("match")))), 0)

    empty = F.array().cast("array<struct<start:int,end:int,kind:int,match:string>>")
    found = F.get(F.transform(F.array(both), lambda b: F.when(F.size(b["m"]) > 0, spans(b)).otherwise(empty)), 0)
    gate = text.rlike(GATES[kind]) if len(GATES.get(kind, "@")) > 1 else F.contains(text, F.lit(GATES[kind])) if kind in GATES else F.col("__digits")
    return F.when(gate, found).otherwise(empty)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]+", "")


def passes(c: Column) -> Column:
    """Whether a candidate of a labelled kind passes its strict check."""
    digits = _digits(c["match"])
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
    return (
        F.when(c["kind"] == 0, F.lit(True))
        .when(c["kind"] == 1, c["match"].rlike(rf"^{part}(?:\.{part}){{3}}$"))
        .when(c["kind"] == 2, F.length(digits).between(12, 19) & F.call_function("luhn_check", F.when(F.length(digits).between(12, 19), digits).otherwise("1")))
        .when(c["kind"] == 3, F.length(digits).between(9, 15))
        .otherwise(F.lit(False))
    )


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__text`` (null as empty) and ``__found``: every generator's spans, sorted by start and kind."""
    text = F.col("__text")
    step = docs.withColumn("__text", whole_text(text_col)).withColumn("__digits", text.rlike("[0-9]"))
    step = step.withColumn("__found", F.when(F.col("__digits") | F.contains(text, F.lit("@")) | text.rlike(GATES["masked_email"]), F.sort_array(F.concat(*[_found(text, k) for k in KINDS]))))
    return step.drop("__digits")


def features(text: Column, c: Column) -> dict[str, Column]:
    """The binned features of a candidate; none is the outcome of its kind's check."""
    match, digits = c["match"], _digits(c["match"])
    before = F.lower(F.substring(text, F.greatest(c["start"] - CONTEXT, F.lit(0)) + 1, F.least(c["start"], F.lit(CONTEXT))))
    left, right = F.substring(text, c["start"], F.when(c["start"] > 0, 1).otherwise(0)), F.substring(text, c["end"] + 1, F.lit(1))
    side = lambda x: F.when((x == "") | x.rlike(r"[\x20\x09-\x0D]"), 0).when(x.rlike("[A-Za-z0-9]"), 2).otherwise(1)
    n = F.length(digits)
    level = lambda v, *edges: reduce(lambda acc, e: acc + F.when(v >= e, 1).otherwise(0), edges, F.lit(0))
    marks = F.length(F.regexp_replace(match, r"[A-Za-z0-9]+", ""))
    letters = F.length(F.regexp_replace(match, r"[^A-Za-z]+", ""))
    groups = F.length(F.regexp_replace(F.regexp_replace(match, "[0-9]+", "0"), "[^0]+", ""))
    varied = F.size(F.array_distinct(F.split(digits, "")))
    return {
        "digits": level(n, 1, 7, 9, 12, 16, 20), "marks": level(marks, 1, 3, 5), "letters": level(letters, 1, 6),
        "groups": level(groups, 2, 3, 4), "hint": reduce(or_, [F.contains(before, F.lit(h)) for h in HINTS]).cast("int"),
        "left": side(left), "right": side(right), "varied": level(varied, 3, 5),
        "plus": F.startswith(match, F.lit("+")).cast("int"), "at": F.contains(match, F.lit("@")).cast("int"),
    }


def training_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Feature vectors of all labelled candidates with the counts that pass and fail, in a fitting and a held-out part.

    At most ``2 * product of the bins`` rows, whatever the input.
    """
    held = (F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(HELD_OUT)) == 0).alias("held")
    rows = candidates(docs.select(F.col(id_col), F.col(text_col)), text_col).select(held, "__text", F.explode_outer("__found").alias("c"))
    c = F.col("c")
    labelled = rows.filter(c["kind"] < len(LABELLED))
    named = [v.alias(k) for k, v in features(F.col("__text"), c).items()]
    return labelled.select("held", *named, passes(c).alias("good")).groupBy("held", *FEATURES).agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))


class Boosted:
    """Depth-two regression trees on log-odds over counted feature vectors, and a calibrated threshold.

    ``trees`` holds ``(feature, cut, (feature, cut, low, high), (feature, cut, low, high))``;
    a value below the cut goes to the first side.
    """

    def __init__(self, rows: list[dict], rounds: int = ROUNDS, rate: float = RATE, precision: float = PRECISION, support: int = SUPPORT):
        fit = [r for r in rows if not r["held"]]
        good, bad = sum(r["good"] for r in fit), sum(r["bad"] for r in fit)
        self.bias, self.trees = math.log((good + 1) / (bad + 1)), []
        scores = [self.bias] * len(fit)
        for _ in range(rounds if good and bad else 0):
            slopes = []
            for r, s in zip(fit, scores):
                p, n = 1 / (1 + math.exp(-s)), r["good"] + r["bad"]
                slopes.append((r["good"] - n * p, n * p * (1 - p)))
            first = self._split(fit, slopes, range(len(fit)))
            if not first:
                break
            sides = []
            for side in first[2:4]:
                sub = self._split(fit, slopes, side)
                if sub:
                    sides.append((sub[0], sub[1], *[rate * self._leaf(slopes, x) for x in sub[2:4]]))
                else:
                    sides.append(("plus", 9, rate * self._leaf(slopes, side), 0.0))
            self.trees.append((first[0], first[1], *sides))
            scores = [s + self._tree(self.trees[-1], r) for r, s in zip(fit, scores)]
        self.threshold = self._calibrate([r for r in rows if r["held"]] or rows, precision, support)

    @staticmethod
    def _leaf(slopes, at) -> float:
        return sum(slopes[i][0] for i in at) / (sum(slopes[i][1] for i in at) + 1.0)

    def _split(self, rows, slopes, at):
        """The best cut of these rows as (feature, cut, rows below, rows from it), or None."""
        gain = lambda g, h: g * g / (h + 1.0)
        g_all, h_all = sum(slopes[i][0] for i in at), sum(slopes[i][1] for i in at)
        best = None
        for f, bins in FEATURES.items():
            sums = [[0.0, 0.0] for _ in range(bins)]
            for i in at:
                sums[rows[i][f]][0] += slopes[i][0]
                sums[rows[i][f]][1] += slopes[i][1]
            g = h = 0.0
            for cut in range(1, bins):
                g, h = g + sums[cut - 1][0], h + sums[cut - 1][1]
                won = gain(g, h) + gain(g_all - g, h_all - h) - gain(g_all, h_all)
                if won > 1e-6 and (best is None or won > best[0] + 1e-12):
                    best = (won, f, cut)
        if best is None:
            return None
        _, f, cut = best
        return f, cut, [i for i in at if rows[i][f] < cut], [i for i in at if rows[i][f] >= cut]

    @staticmethod
    def _tree(tree, row) -> float:
        f, cut, low, high = tree
        f2, cut2, a, b = low if row[f] < cut else high
        return a if row[f2] < cut2 else b

    def score(self, row: dict) -> float:
        return self.bias + sum(self._tree(t, row) for t in self.trees)

    def _calibrate(self, rows, precision: float, support: int) -> float | None:
        """The lowest score from which all held-out candidates reach the precision; None if there is none."""
        tally: dict[float, list[int]] = {}
        for r in rows:
            t = tally.setdefault(round(self.score(r), 9), [0, 0])
            t[0] += r["good"]
            t[1] += r["bad"]
        good = bad = 0
        found = None
        for s in sorted(tally, reverse=True):
            good, bad = good + tally[s][0], bad + tally[s][1]
            if good >= precision * (good + bad) and good + bad >= support:
                found = s
        return found

    def column(self, f: dict[str, Column]) -> Column:
        """The score as an expression over feature columns."""
        half = lambda t: F.when(f[t[0]] < t[1], t[2]).otherwise(t[3])
        trees = [F.when(f[t[0]] < t[1], half(t[2])).otherwise(half(t[3])) for t in self.trees]
        return reduce(lambda a, b: a + b, trees, F.lit(float(self.bias)))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> Boosted:
    return Boosted([r.asDict() for r in training_table(docs, id_col, text_col).orderBy("held", *FEATURES).collect()], **params)


def with_spans(docs: DataFrame, model: Boosted, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__text``, ``__base`` and ``__spans``: the base spans, and those with what the trees add.

    An added span never overlaps a base span, nor a better or equal earlier added one.
    """
    text = F.col("__text")
    empty = F.array().cast("array<struct<start:int,end:int,kind:int,match:string>>")
    step = candidates(docs, text_col)
    found = F.col("__found")
    step = step.withColumn("__base", F.filter(F.coalesce(found, empty), lambda c: (c["kind"] < len(BASE_KINDS)) & passes(c)))
    if model.threshold is None:
        return step.withColumn("__spans", F.col("__base")).drop("__found")
    names = list(FEATURES)

    def judged(c: Column) -> Column:
        f = features(text, c)
        vector = F.struct(*[f[k].alias(k) for k in names])
        score = F.get(F.transform(F.array(vector), lambda v: model.column({k: v[k] for k in names})), 0)
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"), c["match"].alias("match"), score.alias("score"))

    meets = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    free = F.filter(F.coalesce(found, empty), lambda c: (c["kind"] >= len(BASE_KINDS)) & ~F.exists("__base", lambda b: meets(b, c)))
    step = step.withColumn("__free", F.filter(F.transform(free, judged), lambda c: c["score"] >= model.threshold)).drop("__found")
    beats = lambda o, c: (o["score"] > c["score"]) | (o["score"] == c["score"]) & ((o["start"] < c["start"]) | (o["start"] == c["start"]) & (o["kind"] < c["kind"]))
    own = F.filter("__free", lambda c: ~F.exists("__free", lambda o: meets(o, c) & beats(o, c)))
    bare = F.transform(own, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"), c["match"].alias("match")))
    return step.withColumn("__spans", F.sort_array(F.concat("__base", bare))).drop("__free")


def by_place(spans: Column) -> Column:
    """Spans in the order of start, then kind as listed."""
    return F.sort_array(F.transform(spans, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(by_place(spans), lambda c: F.concat_ws(":", F.get(kinds, c["kind"]), c["start"], c["end"])), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Boosted | None = None) -> DataFrame:
    """The contract's rows, one per input row.

    Null text is empty and has no spans; null ids and repeated rows give a row
    each; other columns are ignored.  Without candidates to learn from, the
    trees add nothing.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    step = with_spans(docs, model or fit(docs))
    count = lambda k: F.size(F.filter("__base", lambda c: c["kind"] == k)).cast("long")
    return step.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)],
        F.sha2(written(F.col("__base")), 256).alias("base_sha256"), written(F.col("__spans")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Boosted | None = None) -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    step = with_spans(docs, model or fit(docs, id_col, text_col), text_col).withColumn("__spans", by_place(F.col("__spans")))
    kinds = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def put(acc: Column, c: Column) -> Column:
        gap = F.substring(F.col("__text"), acc["at"] + 1, c["start"] - acc["at"])
        grown = F.concat(acc["out"], gap, F.get(kinds, c["kind"]))
        return F.struct(F.when(c["start"] < acc["at"], acc["out"]).otherwise(grown).alias("out"), F.greatest(acc["at"], c["end"]).alias("at"))

    joined = F.aggregate("__spans", start, put, lambda acc: F.concat(acc["out"], F.substring(F.col("__text"), acc["at"] + 1, F.length("__text"))))
    out = step.withColumn(text_col, F.when(F.size("__spans") > 0, joined).otherwise(F.col(text_col)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("__spans") > 0, F.length(text_col).cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op6_pii(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
