from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from llm import components, decontam, jaccard, passages, toxicity
from llm.common import shared_folder, table
from llm.fmindex import FmIndex, suffix_order
from llm.words import hashed_words, shingles, word_list
from tests.llm.conftest import SF_DIR, real, words

EDGE = [(1, None), (2, ""), (3, "!!!"), (4, "one"), (4, "one"), (None, "two words"), (None, "two words"), (5, "one"), (6, "x " * 60000)]


def text(n, seed=0):
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(n))


def test_words_equal_the_pattern():
    texts = [None, "", "A-b_C é9", "ÄÖ ﬀ x", "a" * 3000, "İI", *(d["text"] for d in real("documents")[:50])]
    hashes, bounds = hashed_words(pa.array(texts))
    seen = {}
    for t, a, b in zip(texts, bounds, bounds[1:], strict=False):
        own = [w.encode() for w in words(t)]
        assert own == word_list(t or "") and len(own) == b - a
        for w, h in zip(own, hashes[a:b].tolist(), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_shingles():
    hashes, bounds = hashed_words(pa.array(["a b c d e f", "a b", "", "b c d e f", "a b"]))
    runs, at = shingles(hashes, bounds)
    assert np.diff(at).tolist() == [2, 1, 0, 1, 1] and runs[1] == runs[3] and runs[2] == runs[4]


def test_fm_index():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 300):
        t = rng.integers(1, 5, n)
        t = np.concatenate((t, t[: n // 2]))
        assert suffix_order(t).tolist() == sorted(range(len(t)), key=lambda i, t=t: t[i:].tolist())
        index, plain = FmIndex(t, 5), t.tolist()
        for m in (1, 2, 4):
            patterns = rng.integers(1, 6, (40, m))
            for p, low, high in zip(patterns.tolist(), *index.search(patterns), strict=True):
                assert sorted(index.locate(np.arange(low, high)).tolist()) == [i for i in range(len(plain) - m + 1) if plain[i : i + m] == p]


def leaks(docs, items):
    windows = defaultdict(set)
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add("" if item is None else str(item))
    out = []
    for t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= own
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block, shard", [(decontam.BLOCK_CHARS, decontam.SHARD), (300, 64)])
def test_decontamination_equals_plain_python(spark, tables, monkeypatch, block, shard):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", block)
    monkeypatch.setattr(decontam, "SHARD", shard)
    r = random.Random(1)
    items = [(1, text(14, 1)), (10, text(10, 2)), (2, "tiny item"), (2, text(30, 3)), (None, "rare"), (7, None), (8, ""), (9, "x " * 12)]
    pool = [t for _, t in items if t] + [text(8, k) for k in range(5, 9)]
    docs = [" ".join(r.choices(pool, k=r.randint(0, 4))).replace(" ", r.choice([" ", ", ", "\n"])) for _ in range(60)]
    docs += [None, "", "TINY-ITEM", "tiny", text(14, 1)[:-1], "x " * 5000, docs[0]]
    sf_dir = tables(documents=[("doc_id", "text", "items"), *((i, t, "q") for i, t in enumerate(docs))], benchmark=[("item_id", "text"), *items])
    got = sorted(tuple(x) for x in decontam.op1_decontamination(spark, sf_dir).collect())
    assert [g[1:] for g in got] == leaks(docs, items)
    cleaned = decontam.clean(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    assert cleaned.columns == ["doc_id", "text", "items"]
    kept = {x.doc_id: x.text for x in cleaned.collect()}
    for i, (t, g) in enumerate(zip(docs, got, strict=True)):
        assert (i in kept) == (g[2] < max(1, decontam.DROPPED_FROM * g[1]))
        if i in kept:
            assert kept[i] == t if not g[2] else len(words(kept[i])) == g[1] - g[2]


def test_decontamination_without_rows(spark, tables):
    sf_dir = tables(documents=[("doc_id", "text"), *EDGE], benchmark=[("item_id", "text")])
    assert {x.contaminated for x in decontam.op1_decontamination(spark, sf_dir).collect()} == {False}
    sf_dir = tables(documents=[("doc_id", "text")], benchmark=[("item_id", "text"), (1, "a")])
    assert decontam.op1_decontamination(spark, sf_dir).count() == 0


def test_automata_meet_what_is_one_edit_away():
    entries = ["idiot", "clown", "worthless"]
    trie = toxicity.Trie(entries)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, last = [i + 1], row
            for j, y in enumerate(b):
                row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
        return row[-1]

    r = random.Random(5)
    reader = toxicity.Lexicon(entries).reader()
    for _ in range(3000):
        w = list(r.choice(entries))
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(w) + 1)
            w[at : at + r.randint(0, 1)] = r.choices("idotclwnrhes", k=r.randint(0, 1))
        w = "".join(w)
        near = min(distance(w, e) for e in entries)
        assert (trie.near(w, 1) is not None) == (near <= 1)
        assert reader.kind(w) == (1 if w in entries else 2 if near == 1 else 0)


def test_quotation_counts_apart():
    reader = toxicity.Lexicon(["idiot"], ["scum"]).reader()
    hits, quoted, close = reader.features('he said "you idiot" and left')
    assert hits == 0 and quoted > 0 and close == 0
    hits, quoted, close = reader.features("you idiot, you SCUMBAG")
    assert hits > 0 and quoted == 0 and close > reader.features("idiot " + "x " * 30 + "scum")[2]
    assert reader.features(None) == reader.features("") == (0.0, 0.0, 0.0)


def test_marks_beside_a_word_and_long_quotations():
    reader = toxicity.Lexicon(words=["idiot"]).reader()
    for text in ("idiot", "(idiot)", "idiot’s", "‘idiot’", "„idiot\nand", "“idiot"):
        assert reader.features(text)[0] > 0 and reader.features(text)[1] == 0, text
    for text in ("“idiot”", "«idiot»", "„idiot“", '"idiot ' + "and so on " * 200 + '"', "“x idiot " + "word " * 300 + "idiot”"):
        assert reader.features(text)[0] == 0 and reader.features(text)[1] > 0, text
    assert reader.features('"idiot and\n so on"')[1] == 0


def test_toxicity_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in real("labels", sf_dir)}
    got = toxicity.op2_toxicity(spark, sf_dir).collect()
    assert len(got) == len(real("documents", sf_dir))
    right = n = 0
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        if r.held_out and r.doc_id in labels:
            n, right = n + 1, right + (r.predicted == labels[r.doc_id])
    assert n > 300 and right / n > 0.97


def test_toxicity_edges(spark, tables):
    docs = [("doc_id", "text", "score"), *((i, t, "s") for i, t in EDGE)]
    for labels in ([], [(1, None), (None, 1)], [(4, 1), (4, 0)], [(4, 1), (5, 0), (6, 0), (6, 0)]):
        sf_dir = tables(documents=docs, labels=[("doc_id", "toxic"), *labels])
        got = toxicity.op2_toxicity(spark, sf_dir).collect()
        assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
        kept = toxicity.keep_clean(table(spark, sf_dir, "documents"), toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
        assert kept.columns == ["doc_id", "text", "score"]


def similar(texts):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    return links


def reached(links, i):
    seen, todo = {i}, [i]
    while todo:
        new = links[todo.pop()] - seen
        seen |= new
        todo += new
    return min(seen)


@pytest.mark.parametrize("small, tile", [(64, 1024), (3, 8)])
def test_jaccard_join_equals_all_pairs(spark, tables, monkeypatch, small, tile):
    """With small buckets of 3 and tiles of 8 the recursion and the tiles are in use; a third of all rows is one group."""
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "TILE", tile)
    r = random.Random(3)
    texts = []
    for k in range(25):
        own = text(60, k).split()
        for _ in range(40 if k == 0 else r.randint(1, 4)):
            copy = list(own)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                copy[r.randrange(len(copy))] = "".join(r.choices("xyz", k=6))
            texts.append(" ".join(copy))
    texts += [None, "", "...", "one", "ONE", "two three", text(4, 1), text(4, 1)]
    links = similar(texts)
    sf_dir = tables(documents=[("doc_id", "text", "n_links"), *((i, t, "q") for i, t in enumerate(texts))])
    got = {x.doc_id: x for x in jaccard.op5_jaccard_join(spark, sf_dir).collect()}
    found, there = sum(x.n_links for x in got.values()), sum(map(len, links.values()))
    assert all(got[i].n_links <= len(links[i]) for i in range(len(texts))) and found >= 0.99 * there
    assert np.mean([got[i].class_id == reached(links, i) for i in range(len(texts))]) > 0.97
    kept = jaccard.keep_one(table(spark, sf_dir, "documents"))
    assert kept.columns == ["doc_id", "text", "n_links"]
    assert sorted(x.doc_id for x in kept.collect()) == sorted(i for i, x in got.items() if x.kept)


def test_jaccard_edges(spark, tables):
    sf_dir = tables(documents=[("doc_id", "text"), *EDGE])
    got = sorted(((r.doc_id or 0, r.n_links, r.class_id) for r in jaccard.op5_jaccard_join(spark, sf_dir).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 2, 4), (4, 2, 4), (5, 2, 4), (0, 1, None), (0, 1, None), (6, 0, 6)], key=str)
    assert sorted((r.doc_id or 0) for r in jaccard.keep_one(table(spark, sf_dir, "documents")).distinct().collect()) == [0, 1, 2, 3, 4, 6]
    assert jaccard.op5_jaccard_join(spark, tables(documents=[("doc_id", "text")])).count() == 0


def test_one_of_each_class_stays_where_doc_ids_repeat(spark, tables):
    """Unlinked texts under one doc_id all stay, and of equal rows one does."""
    one, two, three = text(30, 600), text(30, 601), text(30, 602)
    rows = [(1, one, "a"), (1, two, "a"), (1, None, "a"), (1, three, "a"), (2, one, "a"), (3, two + " end", "a"), *[(7, text(30, 603), s) for s in "cba"], (9, None, "a"), (9, None, "a"), (None, three, "a"), *[(None, "two words", "a")] * 2]
    kept = jaccard.keep_one(table(spark, tables(documents=[("doc_id", "text", "source"), *rows]), "documents"))
    got = sorted(((x.doc_id, x.text) for x in kept.collect()), key=str)
    assert got == sorted([(1, one), (1, two), (1, None), (1, three), (7, text(30, 603)), (9, None), (9, None), (None, "two words")], key=str)


def test_components(spark):
    r = random.Random(9)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)] + [(0, 2000 + i) for i in range(200)] + [(5, 5)]
    links = defaultdict(set)
    for a, b in pairs:
        if a != b:
            links[a].add(b)
            links[b].add(a)
    got = {x.node: x.component for x in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: reached(links, n) for n in list(links)}


def test_compact_windows_equal_plain_ones():
    """Of several documents at once, ties among the hashes included: the windows, and that each stretch lies in one."""
    rng = np.random.default_rng(0)
    for k in range(60):
        bounds = np.cumsum([0, *rng.integers(0, 60, int(rng.integers(1, 5)))])
        h = rng.integers(1, 12 if k % 2 else 10**9, bounds[-1]).astype(np.uint64)
        width = int(rng.integers(2, 12))
        got = set(zip(*(x.tolist() for x in passages.windows(h, bounds, width)), strict=True))
        want = set()
        for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
            for c in range(a, b):
                left = next((i + 1 for i in range(c, a - 1, -1) if h[i] < h[c]), a)
                right = next((i - 1 for i in range(c, b) if h[i] < h[c]), b - 1)
                if right - left + 1 >= width and not (c > a and h[c - 1] == h[c]):
                    want.add((int(h[c]), c, left, right))
            for x in range(a, b - width + 1):
                assert any(v == h[x : x + width].min() and left <= x and x + width - 1 <= right for v, _, left, right in got)
        assert got == want


def test_keys_hold_each_repeated_passage_and_most_near_ones():
    """A stretch of 50 words has the same keys wherever it stands; of near ones the share that is found is measured."""
    r, near = random.Random(4), []
    for n in range(300):
        base = text(50, 5000 + n).split()
        changed = list(base)
        own = {tuple(base[i : i + 5]) for i in range(46)}
        like = 1.0
        while n % 3 and like > 0.84:
            changed[r.randrange(50)] = f"z{r.random()}"
            other = {tuple(changed[i : i + 5]) for i in range(46)}
            like = len(own & other) / len(own | other)
        docs = [text(r.randrange(60), 6000 + n * 2 + k) + " " + " ".join(x) + " " + text(r.randrange(60), 7000 + n * 2 + k) for k, x in enumerate((base, changed))]
        key, doc, lo, hi = passages._keys(*shingles(*hashed_words(pa.array(docs)), 5))
        assert ((hi - lo >= 0) & (hi - lo < 46)).all()
        met = bool(set(key[doc == 0].tolist()) & set(key[doc == 1].tolist()))
        if like == 1.0:
            assert met
        elif like >= 0.8:
            near.append(met)
    assert len(near) > 60 and sum(near) >= 0.9 * len(near)


def test_equal_texts_are_one_passage_and_one_stays(spark, tables):
    long, short = text(80, 900), text(20, 901)
    rows = [(1, long), (2, long), (2, long), (None, long), (4, short), (5, short), (6, text(70, 902)), (6, text(70, 902)), (7, long + " " + text(60, 903))]
    got = passages.op6_passages(spark, tables(documents=[("doc_id", "text"), *rows])).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (1, 2, None):
            assert r.repeated and r.component_id == 1 and r.n_repeated == 80 and r.spans == "0:80"
        elif r.doc_id == 7:
            assert r.repeated and r.component_id == 1 and r.spans == "0:80"
        else:
            assert not r.repeated and r.n_cut == 0 and r.component_id == r.doc_id
    cut = sorted((r.doc_id or 0, r.n_cut) for r in got if r.repeated)
    assert [c for c in cut if c[0] in (0, 2)] == [(0, 80), (2, 80), (2, 80)]
    assert sum(n for i, n in cut if i in (1, 7)) == 80  # of the text and the one that holds it, one is cut


def test_passages_that_repeat(spark, tables):
    shared, other, near = text(70, 100), text(55, 101), text(120, 102).split()
    changed = [w if i % 45 else "zz" for i, w in enumerate(near, 1)]  # no 50 words in a row are the same
    docs = {
        1: text(80, 1) + " " + shared + " " + text(40, 2),
        2: text(30, 3) + " " + shared + ". " + text(90, 4),
        3: shared.upper(),
        4: text(200, 5),
        5: other + " " + text(60, 6),
        6: text(10, 7) + " " + other,
        7: text(40, 8) + " " + " ".join(near),
        8: " ".join(changed) + " " + text(40, 9),
        9: text(100, 10) + " " + text(45, 100),  # the start of the shared passage, but too short
        10: None,
        11: "",
        12: shared.replace(" ", ", "),
    }
    docs |= {100 + i: text(60, 200 + i) + " " + shared for i in range(40)}  # a third and more of all rows
    sf_dir = tables(documents=[("doc_id", "text", "spans"), *((i, t, "q") for i, t in docs.items())])
    got = {r.doc_id: r for r in passages.op6_passages(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    many = [1, 2, 3, 12, *range(100, 140)]
    for i in many:
        assert got[i].repeated and got[i].component_id == 1 and got[i].n_repeated >= 70
    assert got[1].spans == "80:150" and got[3].spans == "0:70"
    assert got[5].component_id == got[6].component_id == 5 and got[5].n_repeated == 55
    assert got[7].component_id == got[8].component_id == 7
    assert not any(got[i].repeated for i in (4, 9, 10, 11))
    assert sum(got[i].n_cut == 0 for i in many) == 1  # one of them stays


def aligned(a, b):
    """By all pairs of stretches of 50 words or more that begin and end alike: whether any has shingle sets of similarity 0.8."""
    one, two = ([tuple(x[i : i + 5]) for i in range(len(x) - 4)] for x in (a, b))
    for i in range(len(one) - 45):
        for j in [j for j in range(len(two) - 45) if one[i] == two[j]]:
            for x in range(i + 46, len(one) + 1):
                own = set(one[i:x])
                for y in [y for y in range(j + 46, len(two) + 1) if one[x - 1] == two[y - 1]]:
                    other = set(two[j:y])
                    if len(own & other) >= 0.8 * len(own | other) - 1e-9:
                        return True
    return False


def test_stretches_equal_all_pairs():
    """Words inserted, deleted and replaced in a passage, other words around it."""
    r, got, want = random.Random(11), [], []
    for _ in range(60):
        a = r.sample(range(10**6), 58)
        b = list(a)
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(b))
            b[at : at + r.randint(0, 1)] = r.sample(range(10**6, 2 * 10**6), r.randint(0, 1))
        a, b = (r.sample(range(10**7, 10**8), n) + x + r.sample(range(10**7, 10**8), 2) for n, x in ((r.randint(0, 3), a), (r.randint(0, 3), b)))
        got.append(bool(passages.stretches(np.array(a), np.array(b))))
        want.append(aligned(a, b))
    assert got == want and 10 < sum(want) < 60


def test_stretches_of_inserted_words_and_of_several_parts():
    a = np.arange(1000, 1060)
    assert passages.stretches(a, np.insert(a, 30, 7)) == [(0, 60, 0, 61)]
    assert passages.stretches(np.insert(a, 30, 7), a) == [(0, 61, 0, 60)]
    # 49 words alone are too few; beside them a region of 60 stands on its own
    b = np.concatenate((np.arange(49), np.arange(5000, 5040), np.arange(2000, 2060)))
    c = np.concatenate((np.arange(49), np.arange(6000, 6040), np.arange(2000, 2060)))
    assert passages.stretches(b, c) == [(89, 149, 89, 149)]
    assert passages.stretches(b[:60], c[:60]) == []


def test_a_short_line_that_many_share_is_no_passage(spark, tables):
    line = text(35, 300)
    long = text(12, 301) + " " + line + " " + text(12, 302)
    docs = {i: text(60, 400 + i) + " " + (long if i in (20, 33) else line) + " " + text(60, 500 + i) for i in range(40)}
    got = {r.doc_id: r for r in passages.op6_passages(spark, tables(documents=[("doc_id", "text"), *docs.items()])).collect()}
    assert {i for i, r in got.items() if r.repeated} == {20, 33} and got[33].component_id == 20 and got[20].spans == "60:119"


def test_near_passages_around_a_line_that_others_share(spark, tables):
    """Of six documents that hold a line of 46 words two share 52, but for a word: both fail against a leader that holds the line alone."""
    docs = {}
    for n in range(12):
        line, before, after = text(46, 8000 + n).split(), text(2, 8100 + n).split(), text(4, 8200 + n).split()
        for i in range(6):
            middle = [*before, *line, *after] if i < 2 else list(line)
            if i == 1:
                middle[27] = f"z{n}"
            docs[10 * n + i] = text(60, 12000 + 10 * n + i) + " " + " ".join(middle) + " " + text(60, 13000 + 10 * n + i)
    got = {r.doc_id: r for r in passages.op6_passages(spark, tables(documents=[("doc_id", "text"), *docs.items()])).collect()}
    assert {i for i, r in got.items() if r.repeated} == {i for i in docs if i % 10 < 2}
    assert all(got[10 * n + 1].component_id == 10 * n for n in range(12))


def test_near_passages_around_a_line_that_hundreds_share(spark, tables):
    """Four times: of 280 documents that hold a line of 40 words two share 54 around it, but for a word: they meet by what the others lack."""
    docs = {}
    for n in range(4):
        line, before, after = text(40, 14000 + n).split(), text(7, 14100 + n).split(), text(7, 14200 + n).split()
        for i in range(280):
            middle = [*before, *line, *after] if i in (100, 200) else list(line)
            if i == 200:
                middle[27] = f"z{n}"
            docs[1000 * n + i] = text(50, 20000 + 1000 * n + i) + " " + " ".join(middle) + " " + text(50, 30000 + 1000 * n + i)
    got = {r.doc_id: r for r in passages.op6_passages(spark, tables(documents=[("doc_id", "text"), *docs.items()])).collect()}
    assert {i for i, r in got.items() if r.repeated} == {i for i in docs if i % 1000 in (100, 200)}
    assert all(got[1000 * n + 200].component_id == 1000 * n + 100 for n in range(4))


def test_of_two_places_in_a_text_the_later_one_goes(spark):
    grouped = spark.createDataFrame([(1, 3, 5, 10, 20), (1, 3, 5, 100, 110)], "key long, n long, row long, lo int, hi int")
    (pair,) = passages._others(grouped, grouped).collect()
    assert (pair.row, pair.lead, pair.shift, pair.lo, pair.hi) == (5, 5, 90, 100, 110)


def test_two_shingles_a_passage_apart():
    """Of shingles at these places those that a passage may begin with and reach."""
    at, first = np.array([0, 3, 44, 45, 67, 68, 69, 200]), passages.LENGTH - passages.SIZE
    key, lo, hi = passages.spans_apart(at, at.astype(np.uint64))
    assert sorted(zip(lo.tolist(), hi.tolist(), strict=True)) == sorted((int(a), int(b)) for a in at for b in at if first <= b - a <= first + 23)
    assert len(set(key.tolist())) == len(key)


def test_keys_meet_nearly_all_near_passages():
    """Passages of 50 words in which one word is another, so that 41 of 51 shingles are common: the least similar that count."""
    r, met = random.Random(7), 0
    for n in range(300):
        base = text(50, 9000 + n).split()
        changed = list(base)
        changed[r.randrange(4, 46)] = f"z{n}"
        docs = [text(r.randrange(60), 9400 + n * 2 + k) + " " + " ".join(x) + " " + text(r.randrange(60), 10400 + n * 2 + k) for k, x in enumerate((base, changed))]
        key, doc, *_ = passages._keys(*shingles(*hashed_words(pa.array(docs)), 5))
        met += bool(set(key[doc == 0].tolist()) & set(key[doc == 1].tolist()))
    assert met >= 0.98 * 300


def test_tables_on_the_way_are_deleted(spark, tables):
    """Of all that is written only the tables that the answer reads stay."""
    docs = {i: text(60, 11000 + i // 2) + " " + text(60, 11100 + i) for i in range(8)}
    path = tables(documents=[("doc_id", "text"), *docs.items()])
    folder = Path(shared_folder(spark).removeprefix("file://").removeprefix("file:"))
    before = set(folder.glob("llm-*"))
    assert passages.op6_passages(spark, path).filter("repeated").count() == 8
    left = {p.name.split("-")[1] for p in set(folder.glob("llm-*")) - before}
    assert not left & {"records", "candidates", "snippets", "half", "dealt", "grouped"}


def test_near_copies_leave_what_is_read_alone(spark, tables):
    copies = text(40, 14000)
    path = tables(documents=[("doc_id", "text"), (1, copies), (2, copies + " one"), (3, copies), (4, text(40, 14001)), (5, None)])
    folder = Path(shared_folder(spark).removeprefix("file://").removeprefix("file:"))

    def left(before):
        return sorted(p.name.removeprefix("llm-")[:-33] for p in set(folder.glob("llm-*")) - before)

    before = set(folder.glob("llm-*"))
    kept = jaccard.keep_one(table(spark, path, "documents"))
    assert left(before) == ["kept"] and {r.doc_id for r in kept.collect()} == {1, 4, 5}
    before = set(folder.glob("llm-*"))
    got = {r.doc_id: (r.n_links, r.class_id) for r in jaccard.op5_jaccard_join(spark, path).collect()}
    assert left(before) == ["named", "of-class"] and got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (0, 5)}


def test_passages_edges(spark, tables):
    got = passages.op6_passages(spark, tables(documents=[("doc_id", "text"), *EDGE])).collect()
    assert len(got) == len(EDGE)
    assert passages.op6_passages(spark, tables(documents=[("doc_id", "text")])).count() == 0


@pytest.mark.parametrize("n", [5])
def test_real_passages(spark, n):
    docs = real("documents")
    where = defaultdict(set)
    for d in docs:
        w = words(d["text"])
        if len(set(w)) > len(w) / 10:  # runs of one word repeat in themselves
            for i in range(len(w) - 49):
                where[tuple(w[i : i + 50])].add(d["doc_id"])
    want = set().union(*(v for v in where.values() if len(v) > 1))
    got = {r.doc_id for r in passages.op6_passages(spark, SF_DIR).collect() if r.repeated}
    assert len(want - got) <= 0.02 * len(want)
