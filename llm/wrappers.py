"""HTML extraction by inferred wrappers: union-free expressions over the pages of a host.

All pages of a host that share a template, that is the containers of their upper LEVELS, are aligned. A page is read as a
tree; sibling runs that repeat become repeated groups (one tag, or a sequence of up to PERIOD tags), what one page has and
another lacks becomes optional, a run of optional parts in which one recurs becomes a repeated group of them, and text that
differs becomes a slot. So every template has one expression without alternatives. Each task aligns the pages that it reads,
and the tasks' expressions are aligned in two rounds, so no task reads a host. In the expression the main region is
found: from the body down, as long as one part holds nearly all slot text outside of what is no article by its tag, its
role or its telling class. A page's text is that of its region; a page that lacks it is aligned with itself alone.

Blocks are what block elements part; a line break is white space. References are decoded, white space becomes one space,
blocks are joined by two newlines. Comments, scripts, styles and the like are skipped by the tokenizer.

Cases: null and empty html give an empty text; so do pages without article text. Broken tags, unclosed elements and stray
`<` are read as browsers do at about. A null or odd url is a host of its own. Equal rows give equal rows. No rows: no
rows. Other columns are not read. Elements may be nested to any depth; an expression describes the upper DEEP levels, and
what lies below counts as text of the last of them.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table, written

#: Levels whose containers tell templates apart; levels that an expression describes.
LEVELS, DEEP = 3, 200
#: Expressions that a task holds before it passes them on; parts that a template's expressions are first dealt to.
HELD, DEALT = 1000, 64
#: Tags in a sequence that may repeat; share of the text that the next step down must hold.
PERIOD, HOLDS = 4, 0.7
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe|title|head)\b[^>]*>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|<[!?][^>]*>|([^<]+|<)""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
VOID = set("area base br col embed hr img input link meta source track wbr".split())
BLOCK = set("address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
CONTAINERS = set("article aside body blockquote details dialog div fieldset footer form header html main nav section table td th tr ul ol li".split())
# What is no article, by tag, role, and words of class and id.
OUT_TAGS = set("nav footer aside form button select dialog menu option label input iframe object canvas audio video".split())
OUT_ROLES = set("navigation banner contentinfo complementary search form alert dialog menu".split())
OUT_WORDS = re.compile(
    r"^(?:ads?|adv|advert\w*|sponsor\w*|promo\w*|banner\w*|side|sidebar\w*|menu\w*|nav|navbar|navigation|breadcrumbs?|footer|cookies?|notices?|consent|gdpr|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social"
    r"|related|recommend\w*|comments?|commentlist|replies|reply|respond|disqus|discussion|widgets?|masthead|topbar|copyright|toolbar|pagination|pager|search|alert|skip|hidden|outbrain|taboola)$"
)
HEADER_WORDS = re.compile(r"^(?:header|heading-bar|topnav|site-?header|page-?header)$")


@dataclass
class Node:
    key: str
    out: bool = False
    kids: list = field(default_factory=list)  # nodes and, in pages, texts


def _key(name: str, attributes: str, inside_article: bool) -> tuple[str, bool]:
    """A tag with its classes (digits aside), and whether it is no article."""
    if not attributes.strip():
        return name, name in OUT_TAGS or name == "header" and not inside_article
    found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    classes = re.sub(r"\d+", "", html.unescape(found.get("class", ""))).lower().split()
    words = [w for c in [*classes, *found.get("id", "").lower().split()] for w in {c, *re.split(r"[-_0-9]+", c)}]
    out = name in OUT_TAGS or found.get("role", "").lower() in OUT_ROLES or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    out = out or bool(re.search(r"(?:^|\s)hidden(?:\s|$|=)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes))) or name not in ("body", "html", "article", "main") and any(map(OUT_WORDS.match, words))
    out = out or not inside_article and (name == "header" or name not in ("body", "html") and any(map(HEADER_WORDS.match, words)))
    return ".".join([name, *sorted(classes)]), out


def tree(page: str) -> Node:
    root = Node("html")
    stack = [root]
    names = ["html"]
    articles = 0  # open ones

    def close(upto: int) -> None:
        nonlocal articles
        articles -= sum(n in ("article", "main") for n in names[upto:])
        del stack[upto:], names[upto:]

    for m in _TOKEN.finditer(page):
        text = m[8]
        if text is not None:
            stack[-1].kids.append(text)
            continue
        name = (m[3] or m[6] or "").lower()
        if not name or name in ("html", "body"):
            if name == "body" and not (m[2] or m[5]) and len(stack) == 1:
                key, _ = "body", False
                node = Node(key)
                root.kids.append(node)
                stack.append(node)
                names.append("body")
            continue
        if m[2] or m[5]:
            for i in range(len(names) - 1, 0, -1):
                if names[i] == name:
                    close(i)
                    break
                if names[i] in CONTAINERS and name not in CONTAINERS:
                    break
            continue
        if name in BLOCK or name in ("td", "th"):  # ends an open paragraph, and an open item or cell of the same kind
            for i in range(len(names) - 1, 0, -1):
                if names[i] == "p" or names[i] == name and name in ("li", "tr", "td", "th", "dd", "dt", "option"):
                    close(i)
                    break
                if names[i] in CONTAINERS:
                    break
        key, out = _key(name, m[4] or m[7] or "", articles > 0)
        node = Node(key, out)
        stack[-1].kids.append(node)
        if name not in VOID and not (m[4] or m[7] or "").rstrip().endswith("/"):
            stack.append(node)
            names.append(name)
            articles += name in ("article", "main")
    return root


@dataclass
class Pattern:
    """An element of the expression: optional (?), repeated (+), with its text: constant (a digest) while all texts were equal."""

    key: str
    out: bool
    kids: list[Pattern] = field(default_factory=list)
    optional: bool = False
    repeated: bool = False
    constant: str | None = None
    chars: int = 0

    def text(self) -> int:
        return 0 if self.out else self.chars + sum(k.text() for k in self.kids)

    def __str__(self) -> str:
        inner = ("#" if self.constant is None and self.chars else "") + " ".join(map(str, self.kids))
        return f"{self.key}{f'({inner})' if inner else ''}{'+' if self.repeated else ''}{'?' if self.optional else ''}"


def pattern(node: Node, levels: int = DEEP) -> Pattern:
    found = [t.strip() for t in (node.kids if levels else _below(node)) if isinstance(t, str) and t.strip()]
    out = Pattern(node.key, node.out, constant=hashlib.md5(" ".join(found).encode("utf-8", "replace")).hexdigest() if found else "", chars=sum(map(len, found)))
    if levels:
        out.kids = _folded([pattern(k, levels - 1) for k in node.kids if isinstance(k, Node)])
    return out


def _below(node: Node) -> list[str]:
    """All texts at or below a node that may be of an article, in order."""
    found, todo = [], [node]
    while todo:
        at = todo.pop()
        if isinstance(at, str):
            found.append(at)
        elif not at.out or at is node:
            todo.extend(reversed(at.kids))
    return found


def _folded(kids: list[Pattern]) -> list[Pattern]:
    """Sequences that follow on themselves as one repeated sequence."""
    for period in range(1, PERIOD + 1):
        out: list[Pattern] = []
        for kid in kids:
            out.append(kid)
            if len(out) >= 2 * period and all(a.key == b.key for a, b in zip(out[-2 * period : -period], out[-period:], strict=True)):
                again = out[-period:]
                del out[-period:]
                for k, other in zip(range(-period, 0), again, strict=True):
                    out[k] = merged(out[k], other)
                    out[k].repeated = True
        kids = out
    return kids


def merged(a: Pattern, b: Pattern) -> Pattern:
    """The expression for both: what one lacks is optional, texts that differ are a slot."""
    out = Pattern(a.key, a.out and b.out, [], a.optional or b.optional, a.repeated or b.repeated, a.constant if a.constant == b.constant else None, a.chars + b.chars)
    keys_a, keys_b = [k.key for k in a.kids], [k.key for k in b.kids]
    kids: list[Pattern] = []
    for what, i, j, k, n in SequenceMatcher(None, keys_a, keys_b, autojunk=False).get_opcodes():
        if what == "equal":
            kids += [merged(x, y) for x, y in zip(a.kids[i:j], b.kids[k:n], strict=True)]
        else:
            for x in [*a.kids[i:j], *b.kids[k:n]]:
                x.optional = True
                kids.append(x)
    out.kids = _folded(_grouped(kids))
    return out


def _grouped(kids: list[Pattern]) -> list[Pattern]:
    """Runs of optional parts with each part once: what recurs in a run is repeated."""
    out: list[Pattern] = []
    place: dict[str, int] = {}
    for kid in kids:
        if not kid.optional:
            place = {}
        elif kid.key in place:
            at = place[kid.key]
            out[at] = merged(out[at], kid)
            out[at].repeated = True
            continue
        else:
            place[kid.key] = len(out)
        out.append(kid)
    return out


def _packed(p: Pattern) -> list:
    return [p.key, p.out, [_packed(k) for k in p.kids], p.optional, p.repeated, p.constant, p.chars]


def _unpacked(x: list) -> Pattern:
    return Pattern(x[0], x[1], [_unpacked(k) for k in x[2]], *x[3:])


def infer(pages: list[str]) -> Pattern | None:
    found: Pattern | None = None
    for page in pages:
        own = pattern(tree(page))
        found = own if found is None else merged(found, own)
    return found


def _is_step(key: str) -> bool:
    """Whether a part may hold the main region."""
    name = key.split(".")[0]
    return name in CONTAINERS and name not in ("table", "ul", "ol", "blockquote", "li", "tr", "td")


def template(root: Node) -> int:
    """A number of the containers of a page's upper levels."""
    found, level = set(), [("", root)]
    for _ in range(LEVELS):
        level = [(f"{path} {k.key}", k) for path, n in level for k in n.kids if isinstance(k, Node) and not k.out and _is_step(k.key)]
        found.update(path for path, _ in level)
        level = [(path, k) for path, k in level if k.key.split(".")[0] not in ("article", "main")]
    return int.from_bytes(hashlib.md5("\n".join(sorted(found)).encode("utf-8", "replace")).digest()[:8], "big", signed=True)


def region(expression: Pattern) -> list[str]:
    """Keys of the steps down to the main region."""
    at, steps = expression, []
    while True:
        inside = [k for k in at.kids if not k.out and _is_step(k.key)]
        best = max(inside, key=lambda k: (k.key.split(".")[0] in ("article", "main"), k.text()), default=None)
        if best is None or best.text() < HOLDS * at.text() and not (best.key.split(".")[0] in ("article", "main", "body") and best.text()) or not at.text():
            return steps
        if best.repeated and best.key.split(".")[0] not in ("article", "main", "body"):
            return steps  # a list of like parts: the article is all of them
        steps.append(best.key)
        at = best


def extract(page: str | None, steps: list[str] | None) -> str:
    if not page:
        return ""
    root = tree(page)
    nodes = [root]
    for key in steps or []:
        nodes = [k for n in nodes for k in n.kids if isinstance(k, Node) and k.key == key and not k.out]
    if steps is None or not nodes:
        nodes = [root]
        for key in region(pattern(root)):
            nodes = [k for n in nodes for k in n.kids if isinstance(k, Node) and k.key == key and not k.out]
    blocks: list[list[str]] = [[]]

    for node in nodes:
        blocks.append([])
        todo: list = list(reversed(node.kids))  # texts, nodes, and None where a block ends
        while todo:
            kid = todo.pop()
            if kid is None:
                blocks.append([])
            elif isinstance(kid, str):
                blocks[-1].append(kid)
            elif not kid.out:
                name = kid.key.split(".")[0]
                if name in ("br", "td", "th", "img", "wbr"):
                    blocks[-1].append(" ")
                if name in BLOCK:
                    blocks.append([])
                    todo.append(None)
                todo.extend(reversed(kid.kids))
    texts = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


def wrappers(pages: DataFrame) -> DataFrame:
    """host, template, steps (JSON) and expression of each template; pages: host, template, html."""

    def aligned(batches):
        held: dict[tuple, Pattern] = {}

        def out():
            keys = list(held)
            return pa.RecordBatch.from_pydict({"host": [k[0] for k in keys], "template": pa.array([k[1] for k in keys], pa.int64()), "packed": [json.dumps(_packed(held[k])) for k in keys]})

        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                root = tree(page)
                key, own = (host, template(root)), pattern(root)
                held[key] = merged(held[key], own) if key in held else own
            if len(held) >= HELD:
                yield out()
                held = {}
        if held:
            yield out()

    def whole(key, group):
        found: Pattern | None = None
        for x in sorted(group.column("packed").to_pylist()):
            own = _unpacked(json.loads(x))
            found = own if found is None else merged(found, own)
        return found

    def part(key, group):
        return pa.table({"host": [key[0].as_py()], "template": pa.array([key[1].as_py()], pa.int64()), "packed": [json.dumps(_packed(whole(key, group)))]})

    def last(key, group):
        found = whole(key, group)
        return pa.table({"host": [key[0].as_py()], "template": pa.array([key[1].as_py()], pa.int64()), "steps": [json.dumps(region(found))], "expression": [str(found)]})

    packed = "host string, template long, packed string"
    found = written(pages.filter("html <> ''").select("host", "html").mapInArrow(aligned, packed), "aligned")
    found = found.withColumn("part", F.pmod(F.xxhash64("packed"), F.lit(DEALT))).groupBy("host", "template", "part").applyInArrow(part, packed)
    return found.groupBy("host", "template").applyInArrow(last, "host string, template long, steps string, expression string")


def article_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).withColumn("host", host)
    found = written(wrappers(pages), "wrappers").select(F.col("host").alias("of"), F.col("template").alias("like"), "steps")

    @F.pandas_udf("long")
    def templates(page):
        return page.map(lambda p: template(tree(p or "")))

    @F.pandas_udf("string")
    def texts(page, steps):
        return page.combine(steps, lambda p, s: extract(p, json.loads(s) if s else None))

    pages = pages.withColumn("template", templates("html"))
    both = pages.join(found, (F.col("host") == F.col("of")) & (F.col("template") == F.col("like")), "left")
    return both.select("page_id", "url", texts("html", "steps").alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op8_article_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return article_texts(table(spark, sf_dir, "pages"))
