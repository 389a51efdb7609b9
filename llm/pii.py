"""Personal data by candidate boosting, by DataFrame functions alone.

Strict base patterns with their checks (Luhn, parts of an address up to 255, digits of a phone number) are reported as
they are. Beside them high-recall generators propose spans of the same four kinds that overlap freely: spelled-out
mail addresses, numbers without a country code, spaced or bracketed addresses, cards in odd groups. Each has features of
format (digits, groups, blanks, brackets, prefix, what it touches) and of context (telling words before it).

A candidate's label for the boosted trees is a check of its plain form: `at` and `dot` spelled out as one writes them
together, brackets and blanks taken out of an address, any separators out of a card (Luhn), a country prefix or a telling
word before a national number. No feature says whether such a check holds, so a format is as good as its candidates are.
Counts over all candidates are what the trees are fitted on (see boosting.py); one half of the documents, by hash, fits.
The other calibrates a threshold a kind, on those candidates alone that a base span of the kind doesn't overlap: they are
what may be added, and from the threshold on they are.

Cases: a null text is empty and has no spans. Equal rows give equal rows. No rows: no rows, and no model. Where a half
has no positive of a kind, that kind adds nothing. Only doc_id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.boosting import Boosted, fit, threshold
from llm.common import table, written
from llm.spans import SPAN, add_matches, joined, spans

KINDS = ["email", "ip", "card", "phone"]
FEATURES = ["digits", "groups", "blanks", "brackets", "prefix", "mixed", "touches", "cue", "last_group"]
#: Share of positive candidates, among those that may be added, that a threshold must reach in the half that calibrates.
PRECISION = 0.95
# Base patterns. Groups that repeat would recurse in the matcher, so dots of domains, and separators of cards, that join
# nothing are first put out of the way, character for character; the rest is runs of single characters.
DOTS = r"\.(?![A-Za-z0-9-])|(?<![A-Za-z0-9-])\."
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
GAPS = r"[\x20-](?![0-9])|(?<![0-9])[\x20-]"
CARD = r"[0-9][0-9\x20-]{13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Generators.
WIDE_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:@|\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?|\x20(?i:at)\x20)[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?[\[({]\x20?(?i:dot)\x20?[\])}]\x20?|\x20(?i:dot)\x20)[A-Za-z0-9-]{1,63}+){1,8}"
WIDE_IP = r"(?<![0-9.])[0-9]{1,3}(?:(?:\.|\x20\.\x20?|\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])"
WIDE_CARD = r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){13,18}(?![0-9])"
WIDE_PHONE = r"(?<![0-9A-Za-z+])(?:\+|00)?\(?[0-9]{1,4}(?:[\x20().-]{1,2}[0-9]{2,8}){1,5}(?![0-9A-Za-z])"
AT = r"\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?|\x20(?i:at)\x20"
DOT = r"\x20?[\[({]\x20?(?i:dot)\x20?[\])}]\x20?|\x20(?i:dot)\x20"
#: `at` as a word of its own before a plain host: look at example.com.
LOOSE_AT = r"(?i)[^\[({]\x20at\x20[^\x20]*$"
CUES = [r"(?i)mail|contact|write", r"(?i)\bip|addr|host|server", r"(?i)card|visa|pay|credit|account", r"(?i)phone|tel|call|fax|mobile|whatsapp"]


def luhn(value: Column) -> Column:
    """Whether the digits of value (at most a few tens) pass the check."""
    digits = F.reverse(F.regexp_replace(value, "[^0-9]", ""))
    total = F.aggregate(
        F.transform(F.split(digits, ""), lambda d, i: F.when(i % 2 == 1, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int"))),
        F.lit(0),
        lambda a, x: a + F.coalesce(x, F.lit(0)),
    )
    return total % 10 == 0


def n_digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def _positive(v: Column, kind: int, cue: Column) -> Column:
    """Whether a candidate's plain form holds what its kind must."""
    if kind == 0:
        plain = F.regexp_replace(F.regexp_replace(v, AT, "@"), DOT, ".")
        return v.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$") | plain.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$") & ~v.rlike(LOOSE_AT)
    if kind == 1:
        return F.regexp_replace(v, r"[\[\]()\x20]", "").rlike(IP_PARTS)
    if kind == 2:
        return n_digits(v).between(14, 19) & luhn(v)
    return v.rlike(r"^(?:\+|00)") & n_digits(v).between(10, 15) | cue & n_digits(v).between(9, 15)


def _features(m: Column, kind: int) -> Column:
    """Small whole numbers of a candidate: the table of their combinations stays small whatever the input."""
    v = m["v"]
    seps = F.regexp_replace(v, r"[A-Za-z0-9+]", "")
    last = F.regexp_extract(v, "([A-Za-z0-9]+)$", 1)
    cue = m["before"].rlike(CUES[kind])
    none = F.lit(0)
    return F.struct(
        m["s"].alias("s"),
        m["e"].alias("e"),
        F.lit(kind).alias("kind"),
        _positive(v, kind, cue).cast("int").alias("positive"),
        F.least(n_digits(v), F.lit((4, 12, 20, 20)[kind])).alias("digits"),
        F.least(F.size(F.split(v, "[^A-Za-z0-9]+")), F.lit(6)).alias("groups"),
        F.least(F.length(v) - F.length(F.replace(v, F.lit(" "))), F.lit(4)).alias("blanks"),
        F.least(F.length(F.regexp_replace(v, r"[^\[({]", "")), F.lit(3)).alias("brackets"),
        (F.when(v.startswith("+"), 2).when(v.startswith("00"), 1).otherwise(0) if kind == 3 else none).alias("prefix"),
        (none if kind < 2 else F.when(seps.rlike(r"^(.)\1*$") | (seps == ""), 0).otherwise(1)).alias("mixed"),
        (F.when(F.right(m["before"], F.lit(1)).rlike("[A-Za-z0-9._/-]"), 1).otherwise(0) + F.when(F.left(m["after"], F.lit(1)).rlike("[A-Za-z0-9_/-]"), 2).otherwise(0)).alias("touches"),
        cue.cast("int").alias("cue"),
        F.least(F.length(last), F.lit(5)).alias("last_group"),
    )


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, fold, base (spans) and found (candidates with features) of each document."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    df = df.select("doc_id", "text", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("fold"), F.regexp_replace("text", DOTS, "_").alias("dotted"), F.regexp_replace("text", GAPS, "x").alias("grouped"))
    df = add_matches(
        df,
        {"e": (F.col("dotted"), EMAIL), "i": (text, IP), "c": (F.col("grouped"), CARD), "p": (text, PHONE), "we": (text, WIDE_EMAIL), "wi": (text, WIDE_IP), "wc": (text, WIDE_CARD), "wp": (text, WIDE_PHONE)},
    )
    base = F.concat(
        spans(F.col("e"), 0),
        spans(F.filter("i", lambda m: m["v"].rlike(IP_PARTS)), 1),
        spans(F.filter("c", lambda m: n_digits(m["v"]).between(14, 19) & luhn(m["v"])), 2),
        spans(F.filter("p", lambda m: n_digits(m["v"]).between(10, 15)), 3),
    )
    found = F.concat(*[_all(c, k) for k, c in enumerate(("we", "wi", "wc", "wp"))])
    df = df.select("doc_id", "fold", base.alias("base"), found.alias("found"))

    def free(x: Column) -> Column:
        """Whether no base span of the kind overlaps."""
        return ~F.exists("base", lambda b: (b["kind"] == x["kind"]) & (b["s"] < x["e"]) & (x["s"] < b["e"]))

    return df.withColumn("found", F.transform("found", lambda x: x.withField("free", free(x).cast("int"))))


def _all(column: str, kind: int) -> Column:
    return F.transform(column, lambda m: _features(m, kind))


def train(found: DataFrame) -> dict[int, tuple[Boosted, float]]:
    """For each kind the trees and the threshold. The driver gets one line for each combination of features and fold."""
    each = found.select("fold", F.explode("found").alias("x")).select("fold", "x.*")
    sums = [F.sum("positive").alias("positive"), F.sum("free").alias("free"), F.sum(F.col("free") * F.col("positive")).alias("new")]
    counts = each.groupBy("kind", "fold", *FEATURES).agg(F.count("*").alias("n"), *sums).collect()
    out = {}
    for kind in range(len(KINDS)):
        lines = [[r.fold, r.n, r.positive, r.free, r.new, *[r[f] for f in FEATURES]] for r in sorted(counts) if r.kind == kind]
        table_ = np.array(lines, float).reshape(-1, 5 + len(FEATURES))
        (fold, n, positive, free, new), x = table_[:, :5].T, table_[:, 5:]
        own, other = fold == 0, fold == 1
        if positive[own].sum() == 0 or new[other].sum() == 0:
            continue
        model = fit(x[own], n[own], positive[own], FEATURES)
        out[kind] = model, threshold(model.of(x[other]), free[other], new[other], PRECISION)
    return out


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base, every: base spans, and those with the candidates that the trees select."""
    found = written(candidates(docs), "pii-candidates")
    score = F.lit(False)
    for kind, (model, least) in train(found).items():
        score = F.when(F.col("kind") == kind, model.column() >= least).otherwise(score)
    each = found.select(F.explode("found").alias("x")).filter("x.free = 1").select("x.kind", *[f"x.{f}" for f in FEATURES])
    # one line for each selected combination of features: as many as the features have levels, whatever the input
    chosen = sorted(r.level for r in each.distinct().filter(score).select(F.concat_ws(":", "kind", *FEATURES).alias("level")).collect())
    added = F.filter("found", lambda x: (x["free"] == 1) & F.concat_ws(":", x["kind"], *[x[f] for f in FEATURES]).isin(chosen)) if chosen else F.slice("found", 1, 0)
    added = F.transform(added, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))).cast(f"array<{SPAN}>")
    return found.select("doc_id", "base", F.concat("base", added).alias("every"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return found.select("doc_id", *[count(k).alias(f"n_{n}") for k, n in enumerate(KINDS)], F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"), joined(F.col("every"), KINDS).alias("spans"))
