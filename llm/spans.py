"""Places of pattern matches as arrays, by Spark's own functions alone.

`split` gives what stands between the matches and `regexp_extract_all` the matches, both from the same leftmost
non-overlapping search; running sums of their lengths are the places. Code points are counted, ends are exclusive.
Sums run in blocks, so that a text with very many matches costs its matches times a block and no more.

The patterns given here must not recurse in Java's matcher on long runs: repeat single characters, not groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256
SPAN = "struct<s:int,e:int,kind:int>"


def _running(lengths: Column) -> Column:
    """0, then the sums of the first 1, 2, ... entries of a non-empty array."""

    def piece(b: Column) -> Column:
        return F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))

    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
    total = F.transform(blocks, lambda b: F.aggregate(piece(b), F.lit(0), lambda a, x: a + x))
    base = F.aggregate(total, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    inner = F.transform(
        blocks,
        lambda b: F.slice(F.aggregate(piece(b), F.array(F.get(base, b)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))), F.lit(2), F.lit(BLOCK)),
    )
    return F.concat(F.array(F.lit(0)), F.flatten(inner))


def add_matches(df: DataFrame, patterns: dict[str, tuple[Column, str]]) -> DataFrame:
    """df with an array column for each name: structs of v (the match), s and e, before and after (up to 24 characters).

    Three plain projections; Catalyst doesn't copy the costly expressions of one into the next.
    """
    keep = df.columns
    df = df.select("*", *[F.split(text, p, -1).alias(f"{n}_gap") for n, (text, p) in patterns.items()], *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(f"{n}_hit") for n, (text, p) in patterns.items()])
    keep = [*keep, *[f"{n}_{x}" for n in patterns for x in ("gap", "hit")]]

    def lengths(n: str) -> Column:
        """Of gap, match, gap, match, ..."""
        return F.flatten(F.transform(f"{n}_hit", lambda v, i: F.array(F.length(F.get(f"{n}_gap", i)), F.length(v))))

    df = df.select(*keep, *[F.when(F.size(f"{n}_hit") > 0, _running(lengths(n))).alias(f"{n}_at") for n in patterns])

    def matches(n: str) -> Column:
        one = F.transform(
            f"{n}_hit",
            lambda v, i: F.struct(
                v.alias("v"),
                F.get(f"{n}_at", 2 * i + 1).alias("s"),
                F.get(f"{n}_at", 2 * i + 2).alias("e"),
                F.right(F.get(f"{n}_gap", i), F.lit(24)).alias("before"),
                F.left(F.get(f"{n}_gap", i + 1), F.lit(24)).alias("after"),
            ),
        )
        return F.coalesce(one, F.expr("cast(array() as array<struct<v:string,s:int,e:int,before:string,after:string>>)")).alias(n)

    return df.select(*[c for c in keep if not c.endswith(("_gap", "_hit"))], *[matches(n) for n in patterns])


def spans(matches: Column, kind: int) -> Column:
    return F.transform(matches, lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e"), F.lit(kind).alias("kind"))).cast(f"array<{SPAN}>")


def joined(all_spans: Column, kinds: list[str]) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    order = F.array_sort(F.transform(all_spans, lambda x: F.struct(x["s"], x["kind"], x["e"])))
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(order, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
