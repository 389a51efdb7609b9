"""Toxicity: a learned lexicon in a trie, met by Levenshtein automata, with scores from the hits' surroundings.

Learning. A bounded sample of labelled documents (SAMPLE rows of least hash, test fold left out) gives for each word, and
for each beginning of a word, the toxic and the clean documents that hold it. Entries are those which
chance can't explain, and then, greedily, those that explain the most toxic documents left. Copies of a document, known by the least of its five-word shingles, count once; so a
word that merely sits in copies of one toxic document doesn't get in. Beginnings stand for stems with many endings.

Reading. A word hits an entry if it is equal, begins with the stem, or is one edit away from an entry of FUZZY_FROM letters
or more: an automaton that accepts all words within one edit of the text's word runs down the trie of entries. Words one
edit away which clean documents of the sample hold are exceptions. A hit inside of quotation marks that close on the same line counts as quotation.
Hits that stand close together count as abuse more than scattered ones. A logistic model over these sums scores.

Cases: null and empty texts score as texts without hits. Equal rows score alike; repeated labels of a document count as
toxic if any does; null labels don't count. Without both labels in the sample every score is the smoothed share of toxic
rows. No rows: no rows. Texts are the only input of a score; other columns pass through `keep_clean` as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import per_batch, table, texts, written
from llm.memo import Remembered
from llm.words import hashed_words, shingles, word_list

#: Labelled rows that are learned from at most.
SAMPLE = 20_000
#: Lexicon entries at most, documents that an entry needs, share of its documents that must be toxic.
ENTRIES, SUPPORT, PRECISION = 2_000, 3, 0.9
#: A stem counts for this much less than a word that explains as many documents.
STEM_COUNTS = 0.85
#: Lengths of beginnings.
STEMS = range(4, 9)
#: Letters from which on an entry is met by misspellings.
FUZZY_FROM = 5
#: What a misspelled hit counts beside a plain one.
MISSPELLED = 0.7
#: Words around a hit in which others count as close.
CONTEXT = 10
THRESHOLD = 0.7
REMEMBERED = 60_000
# Typographic quotation marks and apostrophes part words, as the ASCII ones do.
_TOKEN = re.compile(r"[\"“”„«»\n]|[^\x00-\x2F\x3A-\x60\x7B-\x7F“”„«»‘’]+")
_PART = str.maketrans(dict.fromkeys("“”„«»‘’", " "))


def words_of(text: str) -> list[bytes]:
    """The distinct words of a text in lower case, cut as _TOKEN cuts them."""
    return list(set(word_list(text.lower().translate(_PART))))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


class Trie:
    def __init__(self, words: list[str]):
        self.root: dict = {}
        for word in words:
            node = self.root
            for letter in word:
                node = node.setdefault(letter, {})
            node[""] = word

    def near(self, word: str, edits: int) -> str | None:
        """An entry within so many edits of word: states of the automaton are (letters read, edits spent)."""

        def closed(states: set[tuple[int, int]]) -> set[tuple[int, int]]:
            todo = list(states)
            while todo:
                i, e = todo.pop()
                if i < len(word) and e < edits and (i + 1, e + 1) not in states:
                    states.add((i + 1, e + 1))
                    todo.append((i + 1, e + 1))
            return states

        stack = [(self.root, closed({(0, 0)}))]
        while stack:
            node, states = stack.pop()
            if "" in node and any(i == len(word) for i, _ in states):
                return node[""]
            for letter, below in node.items():
                if letter:
                    then = {(i + 1, e) for i, e in states if i < len(word) and word[i] == letter}
                    then |= {(j, e + 1) for i, e in states if e < edits for j in (i, i + 1) if j <= len(word)}
                    if then:
                        stack.append((below, closed(then)))
        return None


@dataclass
class Lexicon:
    words: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    exceptions: set[str] = field(default_factory=set)

    def reader(self) -> Reader:
        return Reader(self)


class Reader:
    """kinds(words): 1 for each that hits, 2 for each that hits as a misspelling, else 0."""

    def __init__(self, lexicon: Lexicon):
        self.words, self.stems, self.exceptions = set(lexicon.words), set(lexicon.stems), lexicon.exceptions
        self.stem_lengths = sorted({len(s) for s in self.stems})
        fuzzy = [w for w in lexicon.words if len(w) >= FUZZY_FROM]
        self.trie = Trie(fuzzy)
        # one edit leaves an entry's first two letters, or all behind them, as they are
        self.heads = {(len(w) + d, w[:2]) for w in fuzzy for d in (-1, 0, 1)}
        self.tails = {w[2:] for w in fuzzy}
        self.tail_lengths = sorted({len(t) for t in self.tails})
        self.known = Remembered(lambda new: [self.kind(w.decode("utf-8", "surrogatepass")) for w in new], REMEMBERED)

    def kind(self, word: str) -> int:
        if word in self.words or any(word[:n] in self.stems for n in self.stem_lengths):
            return 1
        n = len(word)
        if (n, word[:2]) in self.heads or any(n - 3 <= t <= n - 1 and word[-t:] in self.tails for t in self.tail_lengths):
            if word not in self.exceptions and self.trie.near(word, 1):
                return 2
        return 0

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Hits, a misspelled one counting MISSPELLED; quoted hits; most hits within CONTEXT words. Each n as 1 - exp(-n)."""
        low = (text or "").lower()
        distinct = words_of(low)
        hits = {w.decode("utf-8", "surrogatepass"): k for w, k in zip(distinct, self.known.all(distinct), strict=True) if k}
        if not hits:
            return 0.0, 0.0, 0.0
        count, quoted, places, at, is_open = [0, 0, 0], 0, [], 0, False
        line_end, last_mark = -1, -1  # of the line of the last hit that stood in quotation marks
        for m in _TOKEN.finditer(low):
            token = m[0]
            if token == "\n":
                is_open = False
            elif token in "\"“”„«»":
                is_open = not is_open if token == '"' else token in "“„«"
            else:
                at += 1
                if kind := hits.get(token):
                    if is_open and m.end() > line_end:
                        line_end = low.find("\n", m.end())
                        line_end = len(low) if line_end < 0 else line_end
                        last_mark = max(low.rfind(c, m.end(), line_end) for c in '"”“»')
                    if is_open and last_mark >= m.end():
                        quoted += 1
                    else:
                        count[kind] += 1
                        places.append(at)
        close = max((sum(1 for q in places[i : i + 50] if q - p <= CONTEXT) for i, p in enumerate(places)), default=0)
        return tuple(float(-np.expm1(-x)) for x in (count[1] + MISSPELLED * count[2], quoted, close))


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray  # the last is the constant
    floor: float | None = None  # the score of all, where there is nothing to learn from


def _counts(sample: DataFrame) -> DataFrame:
    """term, stem, toxic, clean: documents of the sample that hold the word, or a word with the beginning."""

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            found: dict[bool, Counter] = {True: Counter(), False: Counter()}
            for text, label in zip(texts(batch), batch.column("toxic").to_pylist(), strict=True):
                terms = {w.decode("utf-8", "surrogatepass") for w in words_of(text)}
                found[label == 1].update({(w, False) for w in terms} | {(w[:n], True) for w in terms for n in STEMS if n < len(w)})
            keys = list(found[True].keys() | found[False].keys())
            return {"term": [k[0] for k in keys], "stem": [k[1] for k in keys], "toxic": [found[True][k] for k in keys], "clean": [found[False][k] for k in keys]}

        return step

    each = per_batch(sample, make, "term string, stem boolean, toxic long, clean long")
    return each.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _chosen(sample: DataFrame, telling: set[tuple[str, bool]], certain: float) -> Lexicon:
    """Entries that `certain` toxic documents or more hold, then by the documents that they explain anew."""

    def make():
        words, stems = {t for t, s in telling if not s}, {t for t, s in telling if s}

        def step(batch: pa.RecordBatch) -> dict:
            out = []
            for text in texts(batch):
                own = {w.decode("utf-8", "surrogatepass") for w in words_of(text)}
                out.append([*sorted(own & words), *sorted({w[:n] + "*" for w in own for n in STEMS if n < len(w) and w[:n] in stems})])
            runs, bounds = shingles(*hashed_words(batch.column("text")))
            return {"terms": out, "copy": [int(runs[a:b].min() >> np.uint64(1)) if a < b else None for a, b in zip(bounds, bounds[1:], strict=False)]}

        return step

    rows = per_batch(sample.filter("toxic = 1"), make, "terms array<string>, copy long").collect()
    of: dict[str, set[int]] = {}
    for i, r in enumerate({r.copy: r for r in sorted(rows, key=lambda r: r.terms)}.values()):
        for t in r.terms:
            of.setdefault(t, set()).add(i)

    def weight(t: str) -> tuple:  # the most documents; of equals the longer
        return len(of[t]) * (STEM_COUNTS if t.endswith("*") else 1.0), len(t), t

    lexicon, explained = Lexicon(), set()

    def take(t: str) -> None:
        explained.update(of[t])
        (lexicon.stems if t.endswith("*") else lexicon.words).append(t.rstrip("*"))

    def related(t: str, other: str) -> bool:
        a, b = t.rstrip("*"), other.rstrip("*")
        return t.endswith("*") and b.startswith(a) or other.endswith("*") and a.startswith(b)

    # first all that can't be chance: words that don't care for toxicity would all fall into toxic texts that seldom
    left = {t for t in of if len(of[t]) >= certain}
    while left and len(lexicon.words) + len(lexicon.stems) < ENTRIES:
        best = max(left, key=weight)
        take(best)
        left = {t for t in left if t != best and not (related(t, best) and len(of[t] - of[best]) < certain)}
    # then what explains the rest
    while len(lexicon.words) + len(lexicon.stems) < ENTRIES:
        of = {t: own for t, d in of.items() if len(own := d - explained) >= SUPPORT}
        if not of:
            break
        take(max(of, key=weight))
    return lexicon


def _sampled_features(sample: DataFrame, lexicon: Lexicon) -> pd.DataFrame:
    """fold, toxic, the features and the misspelled hits of each document of the sample."""

    def make():
        reader = lexicon.reader()

        def step(batch: pa.RecordBatch) -> dict:
            rows = texts(batch)
            near = [sorted({w.decode("utf-8", "surrogatepass") for w in words_of(t) if reader.known.all([w])[0] == 2}) for t in rows]
            return {"toxic": batch.column("toxic"), "near": near, "x": [list(reader.features(t)) for t in rows]}

        return step

    return per_batch(sample, make, "toxic int, near array<string>, x array<double>").toPandas()


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Weights, none below 0 but the constant: a hit never makes a text more harmless. Newton steps, halved until they help."""
    lines, of = np.unique(np.column_stack((x, np.ones(len(x)), y)), axis=0, return_counts=True)
    x, y = lines[:, :-1], lines[:, -1]
    of = of / np.where(y == 1, of[y == 1].sum(), of[y != 1].sum()) * of.sum() / 2  # both labels weigh alike
    last = np.arange(x.shape[1]) == x.shape[1] - 1

    def loss(w: np.ndarray) -> float:
        return float(of @ np.logaddexp(0, np.where(y == 1, -1, 1) * (x @ w)) + ridge / 2 * w @ w)

    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-(x @ w)))
        uphill = x.T @ (of * (y - p)) - ridge * w
        free = last | (w > 0) | (uphill > 0)
        own = x[:, free]
        step = np.zeros(len(w))
        step[free] = np.linalg.solve((own * (of * p * (1 - p))[:, None]).T @ own + ridge * np.eye(free.sum()), uphill[free])
        for t in 0.5 ** np.arange(30):
            then = np.where(last, w + t * step, np.maximum(w + t * step, 0))
            if loss(then) < loss(w):
                break
        else:
            break
        w = then
    return w


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """From at most SAMPLE labelled rows outside of the test fold; everything that the driver gets is bounded by that."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null").filter(~held_out())
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # SAMPLE rows of two numbers: small enough to send to every task
    sample = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(rows), "doc_id").select("text", "toxic"), "toxic-sample")
    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), sum(v for k, v in n.items() if k != 1)
    if not toxic or not clean:
        return Model(Lexicon(), np.zeros(4), (toxic + 1) / (toxic + clean + 2))
    good = _counts(sample).filter((F.col("toxic") >= SUPPORT) & (F.col("toxic") >= PRECISION * (F.col("toxic") + F.col("clean"))))
    telling = {(r.term, r.stem) for r in good.orderBy(F.desc("toxic"), "term", "stem").limit(10 * ENTRIES).collect()}
    # with a million terms, one in a hundred chances that a single one gets in by chance
    certain = np.log(1e6 / 0.01) / np.log((toxic + clean) / toxic)
    lexicon = _chosen(sample, telling, max(SUPPORT, certain))
    seen = _sampled_features(sample, lexicon)
    lexicon.exceptions = {w for near, label in zip(seen.near, seen.toxic, strict=True) if label != 1 for w in near}
    return Model(lexicon, _logistic(np.array(seen.x.tolist(), float).reshape(-1, 3), (seen.toxic == 1).to_numpy(float)))


def scorer(model: Model):
    """A column function: the score of each text, null as empty."""
    readers: list[Reader] = []

    @F.pandas_udf("double")
    def score(column: pd.Series) -> pd.Series:
        if model.floor is not None:
            return pd.Series(np.full(len(column), model.floor))
        if not readers:
            readers.append(model.lexicon.reader())
        x = np.array([readers[0].features(t) for t in column], float).reshape(-1, 3)
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ model.weights[:3] + model.weights[3], -30, 30))))

    return score


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """docs without those that score THRESHOLD or more."""
    return docs.filter(scorer(model)(F.col("text").cast("string")) < THRESHOLD)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    score = scorer(train(docs, table(spark, sf_dir, "labels")))
    out = docs.select("doc_id", held_out().alias("held_out"), score(F.col("text").cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
