from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from llm import collocations


def brute(docs: list[tuple[str | None, str | None]], longest: int = 3, top: int = 2000) -> set[tuple]:
    f: Counter = Counter()
    n: Counter = Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            own = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(own)
            for size in range(1, longest + 1):
                for i in range(len(own) - size + 1):
                    f[lang, tuple(own[i : i + size])] += 1
    out: dict[str, list] = {}
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= 10}
    for (lang, phrase), a in candidates.items():
        cuts = []
        for k in range(1, len(phrase)):
            left, right = f[lang, phrase[:k]], f[lang, phrase[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(
            g == lang and len(longer) > len(phrase) and 100 * b >= 50 * a and any(longer[i : i + len(phrase)] == phrase for i in range(len(longer)))
            for (g, longer), b in candidates.items()
        )
        if not inside:
            out.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), left, right))
    return {
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, rows in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1)
    }


def found(spark, tables, docs, **options) -> set[tuple]:
    sf_dir = tables(documents=[("doc_id", "text", "lang", "phrase", "n"), *((i, text, lang, "x", "y") for i, (lang, text) in enumerate(docs))])
    rows = collocations.collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"), **options).collect()
    got = {tuple(r) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_equals_brute_force(spark, tables, longest):
    rng = random.Random(longest)
    marks = [" ", "  ", "\t", ", ", ".", "\n", "! "]
    vocabulary = ["a", "B", "É", "ß", "word", "x-y", "'s", "ab", "null"]
    docs = [
        (rng.choice(["en", "en", "en", "de", None, "und"]), "".join(rng.choice(vocabulary[: rng.choice([3, 9])]) + rng.choices(marks, [9, 1, 1, 1, 1, 1, 1])[0] for _ in range(rng.randrange(80))))
        for _ in range(120)
    ]
    docs += [("en", None), ("en", ""), ("en", " .,; "), ("fr", "once only")] + [("en", "new york city hall. New York. in new york")] * 60
    assert found(spark, tables, docs, longest=longest) == brute(docs, longest)


def test_ties_and_top(spark, tables, monkeypatch):
    monkeypatch.setattr(collocations, "PARTS", 3)
    docs = [(lang, f"{a}1 {a}2") for lang in ("en", "de") for a in "zyxwvéutsr" for _ in range(10)]
    assert found(spark, tables, docs, top=4) == brute(docs, top=4)


def test_products_beyond_64_bits(spark):
    big = 3 * 10**14
    schema = "lang string, size int, words array<string>, f long"
    often = spark.createDataFrame([("en", 1, ["a"], big + 7), ("en", 1, ["b"], big + 1), ("en", 2, ["a", "b"], big)], schema)
    row = collocations.scored(often).first()
    assert row.score == 1000000 * big * big // ((big + 7) * (big + 1)) == 999999


def test_no_rows(spark, tables):
    assert found(spark, tables, []) == set()


def test_shorter_phrases_come_from_the_counted_windows(spark, tables):
    sf_dir = tables(documents=[("doc_id", "text", "lang"), (1, "a b c. a b", "en")])
    rows = collocations.counts(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    got = {(r["size"], tuple(r["words"])): r["f"] for r in rows}
    assert got == {(0, ()): 5, (1, ("a",)): 2, (1, ("b",)): 2, (1, ("c",)): 1, (2, ("a", "b")): 2, (2, ("b", "c")): 1, (3, ("a", "b", "c")): 1}
