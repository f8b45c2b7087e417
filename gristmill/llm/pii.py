"""Personal data by weak supervision, with SQL functions only.

Candidates are found by patterns. On each, labelers vote yes, no or nothing: the strict format,
a gazetteer (country codes, top-level domains, card issuers, given names), the last telling word of the
context, and the characters at its edges. Expectation-maximisation estimates from all candidates of
all documents how reliable each labeler is on each kind and how likely each candidate is real; only counts of
vote patterns, a table bounded by kinds and votes, reach the driver. A logistic span classifier
is then trained on those posteriors and scores every candidate. It sees the votes, the length and shape of the span,
and the words on both sides, hashed. Candidates of the base kinds that pass their format check are always
spans; of the wider kinds those that pass theirs and that the classifier accepts.

The classifier learns from about ``TRAIN_ROWS`` candidates of a kind, chosen by hash; the kinds weigh the same. It is fitted
by MLlib, in the JVM.

A match's place is the sum of the pieces before it: the text is split at the matches, and a
window over one document adds up lengths. Places are code points, end exclusive. All
patterns are possessive or start at the head of a run, so they take linear time.

Null text is the empty text. Rows are told apart by row, so equal ids and rows each get their
result. No candidates: no model is fitted, no spans. Extra columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from gristmill.llm.common import dealt, with_row
from gristmill.plans.lineage import settle, without_summary

BASE = ("email", "ip", "card", "phone")
WIDER = ("tel", "ssn", "iban", "name")
KINDS = BASE + WIDER
# The base patterns. A run that holds no match is entered at its head only.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "tel": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Herr|Frau|Monsieur|Madame|Señor|Señora)\.?\x20[A-Z][a-z]++",
}
TITLES = ("Mr", "Ms", "Dr", "Herr", "Frau", "Monsieur", "Madame", "Señor")
# A cheap test that every text with a match passes; all but the first and last need a digit.
HINTS = {
    "ip": r"[0-9]\.[0-9]++\.", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]",
    "tel": r"[0-9][\x20.-][0-9]{4}", "ssn": r"-[0-9]{2}-[0-9]", "iban": r"[A-Z]{2}[0-9]{2}",
}
# What the gazetteer and the context labeler know.
DOMAINS = "com org net edu gov io co info biz de fr es uk eu us ch at it nl be ca au jp".split()
CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47",
         "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84",
         "86", "90", "91", "92", "98", "212", "213", "216", "351", "352", "353", "358", "420", "971", "972")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[0689]|35|6011|64|65|62)"
GIVEN = "Anna Maria Peter Paul John Mary James Robert Michael Linda David Sarah Hans Karl Pierre Marie Jean Juan Carlos".split()
CUES = r"mail|contact|phone|tel\b|call|fax|mobil|card|visa|iban|account|konto|compte|cuenta|\bip\b|host|server|ssn|social|name|patient"
COUNTER = (r"version|isbn|order|serial|total|page|chapter|figure|release|build|part\b|sku|model|film|movie|novel|song"
           r"|\bv$|§|#$")
# Capitalised words that follow a title without being a name.
NO_NAMES = "The This That And Who What When Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()
LABELERS = ("strict", "listed", "context", "edges")
BUCKETS = 6
AROUND, BEHIND = 32, 16
CUTOFF = 0.5
TRAIN_ROWS = 50_000
HASHED = 4_096
# What the labelers are taken to do before any candidate is seen: shares of no, yes and nothing on false and on real
# candidates. Many false candidates have the right form, few stand behind a word that speaks for them.
EXPECTED = {
    "strict": ((0.45, 0.50, 0.05), (0.05, 0.90, 0.05)), "listed": ((0.40, 0.30, 0.30), (0.10, 0.60, 0.30)),
    "context": ((0.30, 0.05, 0.65), (0.02, 0.30, 0.68)), "edges": ((0.38, 0.60, 0.02), (0.05, 0.93, 0.02)),
}
# How much that counts, in candidates for each candidate seen. Words that speak against a candidate are few and
# chosen by hand: what form and edges say of most candidates must not teach that they mean nothing.
HELD = {"strict": 0.5, "listed": 0.5, "context": 4.0, "edges": 0.5}


def with_pieces(texts: DataFrame) -> DataFrame:
    """Replace ``text`` by ``pieces``: structs of each kind's matches, with the number, the length of the
    text before, the match, and what stands before and behind it.

    Hints, matches and gaps are columns of their own, so each pattern runs once over a text, and only over
    texts that can hold a match.
    """
    text, none = F.col("text"), F.array().cast("array<string>")
    titled = text.contains(TITLES[0])
    for title in TITLES[1:]:
        titled = titled | text.contains(title)
    hinted = texts.withColumn("__digit", text.rlike("[0-9]")).withColumns({
        "__email": text.contains("@"), "__name": titled,
        **{f"__{k}": F.when(F.col("__digit"), text.rlike(p)).otherwise(False) for k, p in HINTS.items()}})
    matched = hinted.withColumns({f"__m_{k}": F.when(F.col(f"__{k}"), F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0)))
                                  .otherwise(none) for k in KINDS})
    # There is one gap more than matches.
    split = matched.withColumns({f"__g_{k}": F.when(F.size(f"__m_{k}") > 0, F.split(text, PATTERNS[k], -1)).otherwise(none)
                                 for k in KINDS})

    def of(kind: str) -> Column:
        matches, gaps = F.col(f"__m_{kind}"), F.col(f"__g_{kind}")
        n = F.size(matches)
        aligned = F.arrays_zip(matches.alias("m"), F.slice(gaps, 1, n).alias("g"), F.slice(gaps, 2, n).alias("h"))
        return F.transform(aligned, lambda z, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(z["g"]).alias("gap"), z["m"].alias("value"),
            F.right(z["g"], F.lit(AROUND)).alias("before"), F.left(z["h"], F.lit(BEHIND)).alias("after")))

    return split.select("row", "id", F.concat(*map(of, KINDS)).alias("pieces"))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    n = F.length(number)

    def step(total: Column, i: Column) -> Column:
        x = F.substring(number, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def mod97(value: Column) -> Column:
    """Remainder of an account number: its first four characters go to the end, A is 10, Z is 35."""
    plain = F.regexp_replace(value, " ", "")
    signs = F.split(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.left(plain, F.lit(4))), "")

    def step(total: Column, sign: Column) -> Column:
        code = F.ascii(sign)
        return F.when(code < 58, total * 10 + code - 48).otherwise(total * 100 + code - 55) % 97

    return F.aggregate(signs, F.lit(0), step)


def passes(kind: Column, value: Column, number: Column) -> Column:
    """Whether a candidate passes its kind's format check; without that it is no span."""
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    n = F.length(number)
    return F.when(kind == "ip", small) \
        .when(kind == "card", F.when(n.between(13, 19), luhn(number)).otherwise(False)) \
        .when(kind == "phone", n.between(9, 15)) \
        .when(kind == "ssn", ~number.rlike("^(?:000|666|9)|^...00|0000$")) \
        .when(kind == "iban", (F.length(F.regexp_replace(value, " ", "")) >= 15) & (mod97(value) == 1)) \
        .otherwise(True)


def strict(kind: Column, value: Column, number: Column, passed: Column) -> Column:
    """The strict labeler: the format check, and for some kinds more than that."""
    # Area code and exchange start with 2 to 9 and are no service codes; brackets close; separators agree.
    plan = number.rlike("^[2-9](?!11)[0-9]{2}[2-9](?!11)[0-9]{2}") \
        & value.rlike(r"^(?:\([0-9]{3}\)\x20[0-9]{3}[.-]|[0-9]{3}([\x20.-])[0-9]{3}\1)")
    return F.when(kind == "tel", plan) \
        .when(kind == "name", ~F.element_at(F.split(value, " "), -1).isin(NO_NAMES)) \
        .when(kind == "email", ~value.rlike(r"\.\.|^[.]|[.]@|@-|-\.")) \
        .otherwise(passed)


def votes(row: dict[str, Column]) -> list[Column]:
    """The labelers' votes: 1 yes, 0 no, -1 nothing."""
    kind, value, number = row["kind"], row["value"], row["number"]
    before, after = F.lower(row["before"]), row["after"]
    listed = F.when(kind == "email", F.lower(F.element_at(F.split(value, r"\."), -1)).isin(DOMAINS)) \
        .when(kind == "phone", F.substring(number, 1, 1).isin(*CODES) | F.substring(number, 1, 2).isin(*CODES)
              | F.substring(number, 1, 3).isin(*CODES)) \
        .when(kind == "card", number.rlike(ISSUERS)) \
        .when(kind == "ip", ~value.rlike(r"^(?:0|255)\.")) \
        .when((kind == "name") & F.element_at(F.split(value, " "), -1).isin(GIVEN), True)
    # Of several telling words the last one counts.
    told = f"(?s)^.*(?:({CUES})|({COUNTER}))"
    context = F.when(F.regexp_extract(before, told, 1) != "", 1).when(F.regexp_extract(before, told, 2) != "", 0)
    edges = ~before.rlike(r"[a-z0-9]$") & ~after.rlike("^[A-Za-z0-9]")
    format_vote = strict(kind, value, number, row["passed"])
    return [F.coalesce(c.cast("int"), F.lit(-1)).alias(name)
            for name, c in zip(LABELERS, (format_vote, listed, context, edges))]


def surroundings(value: Column, before: Column, after: Column) -> list[Column]:
    """What the classifier sees of a candidate besides its votes: its shape and the words beside it."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]", "9"), "[a-z]+", "a"), "[A-Z]+", "A")
    word = r"[\p{L}0-9]+"
    return [F.left(shape, F.lit(24)).alias("shape"),
            F.regexp_extract(F.lower(before), rf"({word})[^\p{{L}}0-9]*$", 1).alias("word_before"),
            F.regexp_extract(F.lower(after), rf"^[^\p{{L}}0-9]*({word})", 1).alias("word_after")]


def candidates(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """All documents (row, id) and all candidates (row, kind, start, end, passed, votes, bucket,
    shape, word_before, word_after)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = with_row(dealt(docs.select(F.col(id_col).alias("id"), text.alias("text"))))
    split = settle(with_pieces(source))
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("value")
    one = split.select("row", F.explode("pieces").alias("p")).select("row", "p.*") \
        .withColumn("end", F.sum(F.col("gap") + size).over(upto)).withColumn("start", F.col("end") - size) \
        .withColumn("number", digits(F.col("value")))
    one = one.withColumn("passed", passes(F.col("kind"), F.col("value"), F.col("number")))
    # A run of digits that is no card is no candidate at all.
    one = one.filter((F.col("kind") != "card") | F.length("number").between(13, 19))
    bucket = F.least(F.floor(size / 8), F.lit(BUCKETS - 1)).cast("int").alias("bucket")
    names = ("kind", "value", "number", "before", "after", "passed")
    marked = one.select("row", "kind", "start", "end", "passed", bucket, *votes({n: F.col(n) for n in names}),
                        *surroundings(F.col("value"), F.col("before"), F.col("after")))
    return split.select("row", "id"), settle(marked)


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = 50) -> dict:
    """Posterior of each (kind, votes) by expectation-maximisation over their counts.

    On each kind, every labeler has a distribution over its three votes for real and for false candidates, and the kind
    has a prior. They start from ``EXPECTED`` and one half, which keep counting ``HELD`` times, or once, as much as the kind's
    candidates: so labelers can't swap their meaning, and the prior stays between a quarter and three quarters.
    """
    posterior: dict = {}
    for kind in sorted({kind for kind, *_ in patterns}):
        own = [(vote, n) for k, vote, n in patterns if k == kind]
        total = sum(n for _, n in own)
        table, prior = [[list(EXPECTED[name][c]) for name in LABELERS] for c in (0, 1)], 0.5
        found = {}
        for _ in range(rounds):
            for vote, _ in own:
                false, real = (math.log(p) + sum(math.log(table[c][k][v]) for k, v in enumerate(vote))
                               for c, p in ((0, 1 - prior), (1, prior)))
                found[vote] = 1 / (1 + math.exp(max(-50.0, min(50.0, false - real))))
            prior = (0.5 * total + sum(n * found[vote] for vote, n in own)) / (2 * total)
            for c in (0, 1):
                for k, name in enumerate(LABELERS):
                    # A missing vote, -1, is the last of three.
                    seen = [HELD[name] * total * share for share in EXPECTED[name][c]]
                    for vote, n in own:
                        seen[vote[k]] += n * (found[vote] if c else 1 - found[vote])
                    table[c][k] = [x / sum(seen) for x in seen]
        posterior |= {(kind, vote): p for vote, p in found.items()}
    return posterior


def vote_key() -> Column:
    return F.concat_ws(":", "kind", *LABELERS)


def with_features(rows: DataFrame) -> DataFrame:
    """Add ``features``: votes, length, shape and neighbouring words, each with its kind, hashed to ``HASHED`` places."""
    seen = {f"__f_{c}": F.concat_ws(":", "kind", c) for c in (*LABELERS, "bucket", "shape", "word_before", "word_after")}
    # Words also count over all kinds.
    seen |= {f"__g_{c}": F.col(c) for c in ("kind", "word_before", "word_after")}
    hasher = FeatureHasher(numFeatures=HASHED, inputCols=list(seen), outputCol="features", categoricalCols=list(seen))
    return hasher.transform(rows.withColumns(seen)).drop(*seen)


def train_classifier(marked: DataFrame, patterns: list, posterior: dict):
    """A logistic classifier on soft labels: each candidate is real with its posterior's weight, false with the rest."""
    totals: dict = {}
    for kind, _, n in patterns:
        totals[kind] = totals.get(kind, 0) + n

    def by(column: Column, values: dict) -> Column:
        # At most kinds x votes values, as a constant.
        return F.element_at(F.from_json(F.lit(json.dumps(values)), "map<string,double>"), column)

    draw = F.pmod(F.xxhash64("kind", "start", "shape", "word_before", "word_after"), F.lit(1 << 20)) / float(1 << 20)
    drawn = marked.filter(draw < by(F.col("kind"), {k: min(1.0, TRAIN_ROWS / n) for k, n in totals.items()}))
    real = by(vote_key(), {":".join(map(str, (kind, *vote))): p for (kind, vote), p in posterior.items()})
    # Kinds weigh the same, however many candidates they have.
    share = by(F.col("kind"), {k: 1.0 / min(n, TRAIN_ROWS) for k, n in totals.items()})
    sides = F.array(F.struct(F.lit(1.0).alias("label"), real.alias("weight")),
                    F.struct(F.lit(0.0).alias("label"), (1.0 - real).alias("weight")))
    weighed = with_features(drawn).select("features", share.alias("share"), F.explode(sides).alias("side")) \
        .select("features", "side.label", (F.col("side.weight") * F.col("share")).alias("weight"))
    model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=25, standardization=False).fit(weighed)
    return without_summary(marked.sparkSession, model)


def with_score(marked: DataFrame, model) -> DataFrame:
    return model.transform(with_features(marked)) \
        .withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cutoff: float = CUTOFF,
) -> DataFrame:
    """Per document: row, id, spans (kind, start, end, base, score) by kind, then start."""
    every, marked = candidates(docs, id_col, text_col)
    # At most kinds x votes rows.
    rows = marked.groupBy("kind", *LABELERS).agg(F.count("*").alias("n")).collect()
    patterns = sorted((r["kind"], tuple(r[k] for k in LABELERS), r["n"]) for r in rows)
    base = F.col("kind").isin(*BASE)
    if patterns:
        scored = with_score(marked, train_classifier(marked, patterns, reliabilities(patterns)))
    else:
        scored = marked.withColumn("score", F.lit(0.0))
    scored = scored.filter((base & F.col("passed")) | (~base & F.col("passed") & (F.col("score") >= cutoff)))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("order")
    # A wider candidate that touches a base span is part of it.
    by_start = Window.partitionBy("row").orderBy("start")
    reached = F.max(F.when(F.col("base"), F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(by_start.rangeBetween(0, Window.unboundedFollowing))
    touches = F.coalesce(F.col("reached") > F.col("start"), F.lit(False)) | F.coalesce(F.col("ahead") < F.col("end"), F.lit(False))
    scored = scored.withColumn("base", base).withColumn("reached", reached).withColumn("ahead", ahead) \
        .filter(F.col("base") | ~touches)
    spans = scored.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        order, "start", "end", "kind", "base", "score"))).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return every.join(spans, "row", "left").withColumn("spans", F.coalesce("spans", empty))
