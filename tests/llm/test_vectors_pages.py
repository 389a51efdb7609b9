from __future__ import annotations

import json
import random
import re

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from llm import decontam, embeddings, queries, wrappers
from tests.llm.conftest import SF_DIR, real


def test_bounds_are_rigorous():
    rng = np.random.default_rng(1)
    x = embeddings._unit(np.concatenate((rng.normal(size=(200, 24)), rng.normal(size=(50, 24)) * np.logspace(-6, 6, 24))))
    codes = embeddings.Codes(x)
    value = codes.code * codes.scale[:, None]
    lost = np.abs(x @ x.T - value @ value.T)
    assert (lost <= codes.lost[:, None] + codes.length[:, None] * codes.lost[None, :]).all()


@pytest.mark.parametrize("tile", [embeddings.TILE, 37])
def test_vectors_equal_all_pairs(spark, tables, monkeypatch, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [centres[rng.integers(12)] + rng.normal(size=16) * rng.choice([0.02, 0.15, 0.4]) for _ in range(150)]
    rows += [rows[0] * s for s in (1, 1e-20, 1e20)] + [rows[1]] * 90  # one vector holds a third of all rows
    rows = [r.astype(np.float32).tolist() for r in rows]
    rows += [None, [0.0] * 16, [1.0] * 15 + [None], [1.0] * 15 + [float("nan")], [float("inf")] * 16, [], [1.0, 0.0], [2.0, 0.0]]
    sf_dir = tables(embeddings=[("vec_id", "embedding", "n_links"), *((i, r, "q") for i, r in enumerate(rows)), (0, rows[0], "again"), (None, rows[0], "q")])
    got = {r.vec_id: r for r in embeddings.op3_embeddings(spark, sf_dir).collect()}
    assert len(got) == len(rows) + 1
    good = [i for i, r in enumerate(rows) if r and None not in r and np.isfinite(r).all() and any(r)]
    links = {i: set() for i in range(len(rows))}
    for i in good:
        for j in good:
            if i != j and len(rows[i]) == len(rows[j]):
                a, b = np.array(rows[i], float), np.array(rows[j], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                    links[i].add(j)
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(links[i]), min(seen), i == min(seen)), i


def test_no_vectors(spark, tables):
    assert embeddings.op3_embeddings(spark, tables(embeddings=[("vec_id", "embedding")])).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    from testbed import compare

    connection = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    assert compare.difference(queries.QUERIES[name](spark, SF_DIR), connection, queries.ORACLES[name]) is None


PAGE = (
    '<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav><ul><li><a>Home</a></li><li><a>{0}</a></li></ul></nav><div id="main" class="wrap c{0}">'
    '<div class="sidebar">side {0}</div><article><h1>Title &amp; {0}</h1>{1}<div class="notice">we use cookies</div><!-- c --><script>var x="</p>";</script></article>'
    '<section class="comments"><p>I say {0}</p></section></div><form><p>f</p></form><footer>foot {0}</footer></body></html>'
)


def test_article_of_a_host(spark, tables):
    r = random.Random(1)
    want, rows = {}, []
    for i in range(40):
        blocks = [f"block {k} of\n {i}" for k in range(r.randint(1, 6))]
        items = [f"item {k}" for k in range(r.randint(0, 3))]
        body = "".join(f"<p>{b.replace('of', 'o<b>f</b>')}" + r.choice(["</p>", ""]) for b in blocks) + (f"<ul>{''.join(f'<li>{x}' for x in items)}</ul>" if items else "")
        rows.append((i, f"https://{'a' if i % 3 else 'b'}.example/{i}", PAGE.format(i, body)))
        want[i] = "\n\n".join([f"Title & {i}", *(re.sub(r"\s+", " ", b) for b in blocks), *items])
    odd = [(100, None, None), (101, "x", ""), (102, "https://a.example/q", "<p>alone &lt;b&gt; 1 < 2<br>next"), (103, "https://c.example", "<nav>menu</nav>"), (0, rows[0][1], rows[0][2])]
    got = wrappers.op8_article_text(spark, tables(pages=[("page_id", "url", "html", "text"), *((*x, "q") for x in rows + odd)])).collect()
    assert len(got) == len(rows) + len(odd)
    want |= {100: "", 101: "", 102: "alone <b> 1 < 2 next", 103: ""}
    for x in got:
        assert x.text == want[x.page_id] and x.n_chars == len(want[x.page_id])


def test_real_pages_hold_their_document(spark):
    docs = {d["doc_id"]: d["text"] for d in real("documents", "/root/testdata/sf0.01")}
    n = 0
    for x in wrappers.op8_article_text(spark, "/root/testdata/sf0.01").collect():
        own = docs.get(int(re.search(r"/(\d+)(?:[/.?#]|$)", x.url)[1]))
        if own is not None:
            n += 1
            assert x.text.split("\n\n", 1)[1] == "\n\n".join(" ".join(line.split()) for line in own.split("\n") if line.strip())
    assert n > 100


def test_expression_of_pages():
    found = wrappers.infer(["<body><h1>a</h1><p>x</p><p>y</p>", "<body><h1>b</h1><img><p>z</p>"])
    assert str(found) == "html(body(h1(#) img? p(#)+))"
    found = wrappers.infer(["<body><h2>a</h2><p>b</p><h2>c</h2><p>d</p><h2>e</h2><p>f</p>"])
    assert str(found) == "html(body(h2(#)+ p(#)+))"


def test_a_rare_template_of_a_host(spark, tables):
    """2 % of a host's pages have a teaser where the others have the article, and the article beside it."""
    usual = '<body><div class="wrap"><div class="text"><p>first of {0} with some words</p><p>second of {0} with some more</p></div></div></body>'
    rare = '<body><div class="wrap"><div class="text"><p>Teaser {0}</p></div><div class="story"><p>a long story of {0} that goes on and on</p><p>and on for {0}, and on and on and on</p></div></div></body>'
    rows = [(i, f"https://h.example/{i}", (rare if i % 50 == 7 else usual).format(i)) for i in range(300)]
    for x in wrappers.op8_article_text(spark, tables(pages=[("page_id", "url", "html"), *rows])).collect():
        if x.page_id % 50 == 7:
            assert f"a long story of {x.page_id}" in x.text
        else:
            assert x.text == f"first of {x.page_id} with some words\n\nsecond of {x.page_id} with some more"


@pytest.mark.parametrize("depth", [600, 100_000])
def test_deep_pages(depth):
    page = "<div>" * depth + "<p>deep</p><nav>out</nav>" + "</div>" * depth + "<p>after"
    root = wrappers.tree(page)
    assert str(wrappers.merged(wrappers.pattern(root), wrappers.pattern(root)))
    assert wrappers.template(root) == wrappers.template(wrappers.tree(page))
    assert wrappers.extract(page, None) == "deep\n\nafter"
    found = wrappers.infer([page, page])
    assert str(wrappers._unpacked(json.loads(json.dumps(wrappers._packed(found))))) == str(found)


@pytest.mark.parametrize("n", [30, 500])
def test_optional_parts_that_recur_are_one_group(n):
    """An expression grows with the kinds of parts, not with the pages."""
    r = random.Random(n)
    tags = ["p", "h2", "ul", "pre", "div"]
    found = wrappers.infer([f"<body>{''.join(f'<{t}>{r.random()}</{t}>' for t in r.choices(tags, k=r.randint(1, 30)))}" for _ in range(n)])
    assert sorted(str(k) for k in found.kids[0].kids) == sorted(f"{t}(#)+?" for t in tags)


def test_no_pages(spark, tables):
    assert wrappers.op8_article_text(spark, tables(pages=[("page_id", "url", "html")])).count() == 0


def test_pipeline(spark):
    """Each stage on its own input, against plain rules."""
    import corpus_pipeline
    from llm.common import table

    from tests.llm.test_documents import leaks

    sf_dir = SF_DIR
    docs = table(spark, sf_dir, "documents").cache()
    seen = [{r.doc_id: r.text for r in docs.collect()}]
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        seen.append({r.doc_id: r.text for r in docs.collect()})
    scores = {r.doc_id: r.predicted for r in queries.QUERIES["op2_toxicity"](spark, sf_dir).collect()}
    assert seen[1] == {i: t for i, t in seen[0].items() if not scores[i]}
    assert seen[2].items() <= seen[1].items() and 0.8 * len(seen[1]) < len(seen[2])
    items = [(r["item_id"], r["text"]) for r in real("benchmark")]
    hit = dict(zip(seen[2], leaks(list(seen[2].values()), items), strict=True))
    assert set(seen[3]) == {i for i, h in hit.items() if h[1] < max(1, decontam.DROPPED_FROM * h[0])}
    assert all(seen[3][i] == seen[2][i] for i in seen[3] if not hit[i][1])
    assert not any(h[4] for h in leaks(list(seen[3].values()), items))
    assert set(seen[4]) == set(seen[3]) and not any(re.search("AKIA[A-Z0-9]{14}|[0-9a-f]{16}", t or "") for t in seen[4].values())
    ids = {r.doc_id: r.ids for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()}
    assert set(ids) == set(seen[4])
    assert {r.doc_id: r.ids for r in entry.queries()["pipeline"](spark, sf_dir).collect()} == ids
