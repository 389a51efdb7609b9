"""Phrase collocations by top-order marginalisation.

Every word of a piece begins one window of LONGEST words, padded with nulls behind the piece's end; leading columns
(the word, the next one, ...) hold it. Only these longest windows are counted. ROLLUP sums them to their shorter prefixes,
which are all phrases of fewer words, down to all words of a language: no text is exploded once more for each length.

A candidate is a phrase of 2 words to LONGEST that stands LEAST times or more. Each cut into a first part and the rest gives
floor(SCALE * a * a / (l * r)); the lowest score counts, of equal ones the earliest cut. A candidate goes if a longer
candidate holds it and stands at least INSIDE / 100 as often. Products are decimals of 38 digits: exact for phrases that stand up to
10^15 times.

Counts are combined in the tasks that read the texts, so a frequent phrase is one row of each. Candidates are written before they
are joined to the counts of their parts: both sides are plain scans, and adaptive execution can split a word that many
candidates hold. The best of a language are found among the best of its PARTS parts, so no task sorts a language.

Cases: null and empty texts have no words. A null lang is `und`, and counts together with that. Repeated rows count as often
as they stand. No rows: no rows. Other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import table, written

LONGEST, LEAST, INSIDE, TOP = 3, 10, 50, 2000
SCALE = 1_000_000
#: Parts in which a language's candidates are ranked before they are ranked together.
PARTS = 32
UNDEFINED = "und"
BREAKS, BLANKS = r"[.,;:!?\x0A-\x0D]", r"[\x20\x09]+"


def windows(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, w1 .. w<longest>: the window that each word of docs (text, lang) begins, null behind the end of its piece."""
    text = F.translate(F.col("text").cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNDEFINED))
    pieces = docs.select(lang.alias("lang"), F.explode(F.split(text, BREAKS)).alias("piece"))
    words = pieces.select("lang", F.array_remove(F.split("piece", BLANKS), "").alias("w")).filter(F.size("w") > 0)
    leads = [F.col("w")] + [F.slice("w", k, F.size("w")) for k in range(2, longest + 1)]
    return words.select("lang", F.inline(F.arrays_zip(*leads))).toDF("lang", *_columns(longest))


def _columns(n: int) -> list[str]:
    return [f"w{k}" for k in range(1, n + 1)]


def counts(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, size, words, f: how often each phrase of up to `longest` words stands; size 0 is all words of a language.

    Phrases of the longest size are the counted windows themselves; the shorter ones are their ROLLUP.
    """
    keys = ["lang", *_columns(longest)]
    # one short text for a window: a row of few columns is half the bytes to shuffle. Words hold no blanks or tabs, a lang may
    packed = windows(docs, longest).select(F.concat(F.col("lang"), F.lit("\t"), F.concat_ws(" ", *keys[1:])).alias("window"))
    counted = written(packed.groupBy("window").agg(F.count("*").alias("f")), "longest-windows", compression="zstd")
    words = F.split(F.substring_index("window", "\t", -1), " ", -1)
    lang = F.expr("substring(window, 1, length(window) - length(substring_index(window, '\t', -1)) - 1)")
    top = counted.select(lang.alias("lang"), *[F.get(words, F.lit(k)).alias(c) for k, c in enumerate(keys[1:])], "f")
    rolled = top.rollup(*keys[:-1]).agg(F.sum("f").alias("f"), (F.lit(longest - 1) - F.bit_count(F.grouping_id())).cast("int").alias("size"))
    rolled = rolled.filter("size >= 0").withColumn(keys[-1], F.lit(None).cast("string"))
    every = rolled.unionByName(top.withColumn("size", F.lit(longest)))
    # a prefix that reaches behind the end of its piece is no phrase
    whole = F.coalesce(*[F.when(F.col("size") == k, F.col(f"w{k}").isNotNull()) for k in range(1, longest + 1)], F.lit(True))
    return every.filter(whole).select("lang", "size", F.slice(F.array(*keys[1:]), 1, F.col("size")).alias("words"), "f")


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")  # words hold no blanks


def _part(start: Column, length: Column) -> Column:
    return _phrase(F.slice("words", start, length))


def scored(often: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score of each candidate: the phrases of two words or more of often (of :func:`counts`)."""
    k = F.col("k")
    candidates = often.filter("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = written(candidates.select("lang", "words", F.col("f").alias("a"), "k", _part(F.lit(1), k).alias("left"), _part(k + 1, F.col("size") - k).alias("right")), "cuts")
    one, two = (written(often.filter("size > 0").select("lang", _phrase(F.col("words")).alias(side), F.col("f").alias(f)), "parts") for side, f in (("left", "l"), ("right", "r")))
    found = written(cuts.join(one, ["lang", "left"]), "left-parts").join(two, ["lang", "right"])
    wide = "cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * cast({scale} as decimal(7,0))".format(scale=SCALE)
    score = F.expr(f"({wide}) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return found.groupBy("lang", "words").agg(lowest, F.first("a").alias("a")).select("lang", _phrase(F.col("words")).alias("phrase"), "words", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's `top` phrases of 2 to `longest` words."""
    # the parts of a candidate stand at least as often as it does
    often = written(counts(docs, longest).filter((F.col("f") >= least) | (F.col("size") == 0)), "often")
    longer = often.filter("size > 2").withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    longer = longer.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    around = written(longer.groupBy("lang", _part(F.col("start"), F.col("length")).alias("phrase")).agg(F.max("f").alias("around")), "around")
    ranked = written(scored(often).drop("words"), "scored").join(around, ["lang", "phrase"], "left").filter(F.expr(f"around is null or 100 * around < {inside} * a")).drop("around")

    def best(*keys: str) -> Column:
        return F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase"))

    dealt = ranked.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    first = dealt.withColumn("rank", best("lang", "part")).filter(F.col("rank") <= top)
    first = first.withColumn("rank", best("lang").cast("long")).filter(F.col("rank") <= top)
    total = often.filter("size = 0").select("lang", F.col("f").alias("n"))
    return first.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = """
with piece as (
    select row_number() over () as id, lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') as w
    from (
        select coalesce(lang, 'und') as lang,
            unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
        from documents
    )
),
placed as (select id, lang, unnest(w) as w1, unnest(range(1, len(w) + 1)) as i from piece),
ahead as (
    select lang, w1, lead(w1) over (partition by id order by i) as w2, lead(w1, 2) over (partition by id order by i) as w3 from placed
),
gram as (
    select lang, 1 as size, w1 as phrase from ahead
    union all select lang, 2, w1 || ' ' || w2 from ahead where w2 is not null
    union all select lang, 3, w1 || ' ' || w2 || ' ' || w3 from ahead where w3 is not null
),
f as (select lang, size, phrase, count(*) as f from gram group by all),
n as (select lang, sum(f)::bigint as n from f where size = 1 group by lang),
candidate as (select lang, size, phrase, f as a, string_split(phrase, ' ') as w from f where size > 1 and f >= 10),
cut as (select c.*, k from candidate c, (values (1), (2)) t(k) where k < size),
valued as (
    select c.lang, c.size, c.phrase, c.a, c.k, l.f as l, r.f as r, (1000000::hugeint * c.a * c.a // (l.f::hugeint * r.f))::bigint as score
    from cut c
    join f l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:c.k], ' ')
    join f r on r.lang = c.lang and r.phrase = array_to_string(c.w[c.k + 1:], ' ')
),
lowest as (select * from valued qualify row_number() over (partition by lang, phrase order by score, k) = 1),
around as (
    select lang, phrase, max(a) as longer from (
        select lang, array_to_string(w[1:2], ' ') as phrase, a from candidate where size = 3
        union all select lang, array_to_string(w[2:3], ' '), a from candidate where size = 3
    ) group by all
),
ranked as (
    select v.lang, row_number() over (partition by v.lang order by score desc, v.a desc, v.phrase) as rank, v.phrase, v.a, v.l, v.r, n.n, score
    from lowest v join n on n.lang = v.lang left join around o on o.lang = v.lang and o.phrase = v.phrase
    where o.longer is null or 100 * o.longer < 50 * v.a
)
select * from ranked where rank <= 2000
"""
