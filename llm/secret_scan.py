"""Secret scans with multipart credential linking, by DataFrame functions alone.

Strong patterns (an assignment to a telling name, an access key id, a long hexadecimal run) are reported wherever they
stand. Weak ones, which alone would report far too much, are parts of a credential: a login or client name, a secret-like
token or a short password, and an endpoint. An interval join brings together parts of one document whose distance is at
most SCOPE characters, and a weak part is reported only where its complement is in scope: a login by a secret or a
strong match, a weak secret by a login, an access key id or an endpoint, which may also hold it (a token in a webhook's
address). Distance is from end to start, however long the parts are. The join is on document and on a cell of SCOPE
characters, three cells to be asked, and stops at the first partner; so a document full of parts is split over its cells.

Cases: a null text is empty and has no spans. Equal rows give equal rows. No rows: no rows. Only doc_id and text are read
by `scan`; `redact` gives back all columns whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import row_key, table, written
from llm.spans import SPAN, add_matches, joined, spans

KINDS = ["assign", "access", "hex", "login", "weak"]
SCOPE = 200
# Equal to the base patterns, without retries inside of a dropped match: see the tests.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=-]++"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
LOGIN = r"""(?i:user(?:name)?|login|client_?id|account|key_?id)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9._@+-]{3,}+"""
WEAK_PASS = r"""(?i:pass|pwd|pw|auth|credential|private_?key)["']?\x20*+[:=]\x20*+["']?[^\s"',;<>]{6,}+"""
WEAK_TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+={0,2}+"
ENDPOINT = r"""(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*+://[^\s"'<>]++"""
_VALUE = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?"""


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, row, base (strong spans), logins, weak and ends (parts' spans) of each document."""
    df = row_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    text = F.col("text")
    df = add_matches(
        df.select("doc_id", "row", "text"),
        {"a": (text, ASSIGN), "k": (text, ACCESS), "h": (text, HEX), "l": (text, LOGIN), "p": (text, WEAK_PASS), "t": (text, WEAK_TOKEN), "u": (text, ENDPOINT)},
    )
    strong = F.filter("a", lambda m: F.length(F.regexp_replace(m["v"], _VALUE, "")) >= 12)

    def mixed(m: Column) -> Column:
        v = m["v"]
        return v.rlike("[A-Z]") & v.rlike("[a-z]") & v.rlike("[0-9]")

    return df.select(
        "doc_id",
        "row",
        F.concat(spans(strong, 0), spans(F.col("k"), 1), spans(F.col("h"), 2)).alias("base"),
        spans(F.col("l"), 3).alias("logins"),
        F.concat(spans(F.col("p"), 4), spans(F.filter("t", mixed), 4)).alias("weak"),
        spans(F.col("u"), 5).alias("ends"),
    )


def link(found: DataFrame) -> DataFrame:
    """row, extra: the weak parts of each document that have their complement in scope and overlap no strong span."""

    def cells(column: str | Column) -> DataFrame:
        return found.select("row", F.explode(column).alias("x")).select("row", F.col("x.s").alias("s"), F.col("x.e").alias("e"), F.col("x.kind").alias("kind"))

    asks = cells(F.concat("logins", "weak")).filter(F.col("row").isNotNull()).distinct()
    for_login = cells(F.concat("weak", "base")).selectExpr("row", "s as ps", "e as pe", "false as holds", "3 as asks")
    for_weak = cells(F.concat("logins", "ends", F.filter("base", lambda x: x["kind"] == 1))).selectExpr("row", "s as ps", "e as pe", "kind = 5 as holds", "4 as asks")
    # in every cell that a partner touches: it may be longer than SCOPE, and its nearer end counts
    partners = for_login.union(for_weak).distinct().withColumn("cell", F.explode(F.expr(f"sequence(floor(ps / {SCOPE}), floor(pe / {SCOPE}))")))
    # spans longer than SCOPE are asked for by both their ends
    near = asks.withColumn("cell", F.explode(F.array_distinct(F.concat(*[F.array(F.floor(F.col(c) / SCOPE) + d) for c in ("s", "e") for d in (-1, 0, 1)]))))
    mine = near.alias("a").join(
        partners.alias("p"),
        (F.col("a.row") == F.col("p.row")) & (F.col("a.cell") == F.col("p.cell")) & (F.col("a.kind") == F.col("p.asks"))
        & (F.col("p.ps") - F.col("a.e") <= SCOPE) & (F.col("a.s") - F.col("p.pe") <= SCOPE)
        & ((F.col("p.ps") >= F.col("a.e")) | (F.col("p.pe") <= F.col("a.s")) | F.col("p.holds")),
        "left_semi",
    )
    return mine.groupBy("row").agg(F.collect_set(F.struct("s", "e", "kind")).cast(f"array<{SPAN}>").alias("extra"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, row, base, every: strong spans, and those with the linked weak parts."""
    found = written(parts(docs), "secret-parts")
    some = F.size(F.col("logins")) + F.size(F.col("weak")) > 0
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    linked = found.filter(some).join(link(found.filter(some)), "row", "left")
    # what a strong span covers is reported already
    extra = F.filter(F.coalesce("extra", none), lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    return linked.select("doc_id", "row", "base", F.concat("base", extra).alias("every")).union(found.filter(~some).select("doc_id", "row", "base", F.col("base").alias("every")))


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """docs with every reported span of text put in place by mask; n_chars follows. Needs a text column."""
    names = docs.columns
    keyed = row_key(docs.select(F.struct("*").alias("all"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    places = scan(docs.select("doc_id", "text")).filter(F.size("every") > 0).select("row", F.array_sort(F.transform("every", lambda x: F.struct(x["s"], x["e"]))).alias("every")).dropDuplicates(["row"])
    df = keyed.join(places, "row", "left")
    # of overlapping spans the text from the furthest end so far on is kept, so each character is masked once
    cut = F.aggregate(
        "every",
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out")),
        lambda a, x: F.struct(
            F.greatest(a["at"], x["e"]).alias("at"),
            F.when(x["s"] >= a["at"], F.concat(a["out"], F.array(F.substr("text", a["at"] + 1, x["s"] - a["at"]), F.lit(mask)))).otherwise(a["out"]).alias("out"),
        ),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substr("text", a["at"] + 1, F.length("text"))),
    )
    df = df.withColumn("masked", F.when(F.col("every").isNotNull(), cut).otherwise(F.col("text")))
    out = []
    for c, kind in docs.dtypes:
        if c == "text":
            out.append(F.col("masked").alias("text"))
        elif c == "n_chars":
            out.append(F.when(F.col("every").isNotNull(), F.length("masked").cast(kind)).otherwise(F.col("all.n_chars")).alias(c))
        else:
            out.append(F.col(f"all.`{c}`").alias(c))
    assert len(out) == len(names)
    return df.select(*out)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"), joined(F.col("every"), KINDS).alias("spans")
    )
