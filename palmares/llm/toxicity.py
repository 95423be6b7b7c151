"""Toxicity: Levenshtein automata over a trie of learned terms, scored in their context.

Terms, whole words or word beginnings, are learned from labelled rows by grouped counts. A word of a text
is run through the trie together with the automaton of its edits, so misspelled terms are met without
comparing it to each term. A hit counts less inside quotation marks or beside words that labelled harmless
rows have near their hits, and a logistic curve over the summed evidence gives the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, written

#: Most terms of each kind in a lexicon, rows (texts) that a term must occur in, words to either side of a hit.
MAX_TERMS = 2000
MIN_ROWS = 5
WINDOW = 5
#: Most labelled rows that the lexicon and the curve are learned from; drawn by a hash of the id.
FIT_ROWS = 20_000
#: Lengths of word beginnings that are tried as terms.
STEMS = (4, 5, 6, 7)
_QUOTES = frozenset("\"'«»“”„‘’‹›")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words and automaton states that a task remembers.
_CACHE, _STATES = 1 << 18, 1 << 16


class Trie:
    """A lexicon as a trie, and its product with the automaton of at most ``edits`` edits, made deterministic as it is used.

    Nodes are dictionaries of characters; ``ends`` has (term, weight, is a word beginning) by node. A state of the
    product is the set of (node, edits used) that a word read so far can stand at.
    """

    def __init__(self, terms: list[tuple[str, float, bool]], edits: int = 1):
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[str, float, bool]]] = [[]]
        self.edits = edits
        for term in terms:
            at = 0
            for c in term[0]:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.ends.append([])
                at = self.next[at][c]
            self.ends[at].append(term)
        self._start()

    def _start(self) -> None:
        self.ids: dict[frozenset, int] = {frozenset(): 0}
        self.moves: list[dict[str, int]] = [{}]
        self.sets: list[frozenset] = [frozenset()]
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """The state of ``pairs`` and of what skipped letters of a term reach from them; for each node the fewest edits."""
        least: dict[int, int] = {}
        todo = sorted(pairs, key=lambda p: p[1])
        for node, used in todo:
            if least.get(node, used + 1) <= used:
                continue
            least[node] = used
            if used < self.edits:
                todo += [(child, used + 1) for child in self.next[node].values()]
        key = frozenset(least.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
        return self.ids[key]

    def _move(self, state: int, c: str) -> int:
        reached: set[tuple[int, int]] = set()
        for node, used in self.sets[state]:
            if c in self.next[node]:
                reached.add((self.next[node][c], used))
            if used < self.edits:
                reached.add((node, used + 1))
                reached.update((child, used + 1) for child in self.next[node].values())
        self.moves[state][c] = to = self._state(reached)
        return to

    def search(self, word: str) -> tuple[str, float, int] | None:
        """(term, weight, distance) of the nearest, then heaviest term within the edits of ``word``.

        Word beginnings match as written only; terms of up to four letters too, since so many other words are near them.
        """
        best, at = None, 0
        for c in word:
            at = self.next[at].get(c, -1)
            if at < 0:
                break
            for term, weight, stem in self.ends[at]:
                if stem and (best is None or weight > best[1]):
                    best = (term, weight, 0)
        if len(self.sets) > _STATES:
            self._start()
        state = self.start
        for c in word:
            state = self.moves[state].get(c, -1) if c in self.moves[state] else self._move(state, c)
            if not state:
                return best
        for node, used in self.sets[state]:
            for term, weight, stem in self.ends[node]:
                if not stem and (not used or len(term) > 4) and (best is None or (-used, weight) > (-best[2], best[1])):
                    best = (term, weight, used)
        return best


@dataclass
class Model:
    """A lexicon with the weights of its terms, of context words and of the curve."""

    terms: list[tuple[str, float, bool]]
    context: dict[str, float]
    edits: int = 1
    misspelt: float = 0.6
    quoted: float = 0.25
    bias: float = -3.0
    slope: tuple[float, float] = (1.0, 1.0)

    def trie(self) -> Trie:
        return Trie(self.terms, self.edits)


def bare(word: str) -> str:
    """A word in lower case without what is not a letter or digit at its ends."""
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b].lower()


class Scorer:
    """Evidence of texts under a model; words met before are looked up."""

    def __init__(self, model: Model):
        self.model, self.trie, self.known = model, model.trie(), {}

    def hit(self, word: str) -> tuple[str, float, int] | None:
        if word in self.known:
            return self.known[word]
        if len(self.known) >= _CACHE:
            self.known.clear()
        core = bare(word)
        self.known[word] = found = self.trie.search(core) if core else None
        return found

    def hits(self, text: str | None) -> tuple[list[tuple[int, tuple[str, float, int]]], list[str]]:
        tokens = _WORD.findall(text) if text else []
        known, out = self.known, []
        for k, w in enumerate(tokens):
            found = known[w] if w in known else self.hit(w)
            if found is not None:
                out.append((k, found))
        return out, tokens

    def evidence(self, text: str | None) -> tuple[float, float]:
        """(sum, sum by the root of the length) of the weights of hits, each scaled by its context."""
        found, tokens = self.hits(text)
        m, total = self.model, 0.0
        for k, (_, weight, distance) in found:
            if distance:
                weight *= m.misspelt
            around = [bare(w) for w in tokens[max(0, k - WINDOW) : k] + tokens[k + 1 : k + 1 + WINDOW]]
            if around and m.context:
                lean = sum(m.context.get(w, 0.0) for w in around) / len(around)
                weight *= 2 / (1 + math.exp(-lean))
            if weight > 0 and is_quoted(tokens, k):
                weight *= m.quoted
            total += weight
        return total, total / math.sqrt(1 + len(tokens) / 50)

    def score(self, text: str | None) -> float:
        a, b = self.evidence(text)
        z = self.model.bias + self.model.slope[0] * math.tanh(a / 10) * 10 + self.model.slope[1] * b
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def is_quoted(tokens: list[str], k: int) -> bool:
    """Does a quotation that opens at most WINDOW words before word k end at most WINDOW words after it?"""
    opened = any(w[0] in _QUOTES for w in tokens[max(0, k - WINDOW) : k + 1])
    closed = any(w.rstrip(".,;:!?)")[-1:] in _QUOTES for w in tokens[k : k + 1 + WINDOW] if w)
    return opened and closed


def _cores(text: Column) -> Column:
    """Distinct words of a text, in lower case and bare at their ends."""
    bared = F.regexp_replace(F.lower(text), r"(?<![^\x20\x09-\x0D])[^\p{L}\p{N}\x20\x09-\x0D]+|[^\p{L}\p{N}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])", "")
    return F.array_distinct(F.filter(F.split(bared, r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def _stems(word: Column) -> Column:
    return F.filter(F.array(*[F.when(F.length(word) > k, F.substring(word, 1, k)) for k in STEMS]), lambda s: s.isNotNull())


def learn_terms(labelled: DataFrame, max_terms: int = MAX_TERMS, min_rows: int = MIN_ROWS) -> list[tuple[str, float, bool]]:
    """Words and word beginnings that mark label 1: (term, weight, is a beginning), at most ``max_terms`` of each kind.

    ``labelled`` has text and label. Rows with a term are counted by label; the weight is the log-odds, smoothed, and
    lowered by two standard errors and must then exceed 2, so rare terms need clearer cases. A longer beginning that adds nothing to
    a shorter one is left out.
    """
    base = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = base.get(1, 0), base.get(0, 0)
    if not n1 or not n0:
        return []
    out: list[tuple[str, float, bool]] = []
    for stem in (False, True):
        found = _cores(F.col("text"))
        if stem:
            found = F.array_distinct(F.flatten(F.transform(found, _stems)))
        rows = labelled.select("label", F.explode(found).alias("t"))
        counts = rows.groupBy("t").agg(F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("a"), F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("b"))
        odds = F.log((F.col("a") + 0.5) / (n1 - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (n0 - F.col("b") + 0.5))
        error = F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
        weighed = counts.where(F.col("a") >= min_rows).withColumn("s", odds - 2 * error).where("s > 2")
        top = weighed.orderBy(F.desc("s"), "t").limit(max_terms).collect()
        chosen = {r["t"]: float(r["s"]) for r in top}
        for t, s in sorted(chosen.items(), key=lambda x: (len(x[0]), x[0])):
            covered = stem and any(chosen.get(t[:k], -9.0) >= s - 0.7 for k in STEMS if k < len(t))
            if not covered:
                out.append((t, s, stem))
    # a whole word that a chosen beginning already covers as well adds nothing
    stems = {t: s for t, s, stem in out if stem}
    return [(t, s, stem) for t, s, stem in out if stem or not any(stems.get(t[:k], -9.0) >= s for k in STEMS)]


def fit(labelled: DataFrame, edits: int = 1) -> Model:
    """A model from written rows (doc_id, text, label), of which ``training_rows`` bounds the number.

    Only the lexicon, counts of context words and two numbers a row reach the driver.
    Without rows of both labels, or without terms, every score is about the share of label 1.
    """
    terms = learn_terms(labelled)
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())
    if not terms:
        share = counts.get(1, 0) / n if n else 0.0
        return Model([], {}, edits, bias=math.log((share + 1e-3) / (1 - share + 1e-3)))
    model = Model(terms, {}, edits)
    near = labelled.mapInArrow(_near_hits(model), "label int, term string, w string")
    share = near.groupBy("term").agg(F.avg("label").alias("p"))
    # what a word near hits says beyond the term it stands beside
    lean = near.join(F.broadcast(share), "term").groupBy("w").agg((F.sum(F.col("label") - F.col("p")) / (F.count("*") + 20)).alias("lean"), F.count("*").alias("n"))
    rows = lean.where("n >= 20 and abs(lean) > 0.1").orderBy(F.desc(F.abs("lean")), "w").limit(MAX_TERMS).collect()
    model.context = {r["w"]: 4 * float(r["lean"]) for r in rows}
    got = labelled.mapInArrow(_evidence(model), "label int, a double, b double").collect()
    x = np.array([[1.0, math.tanh(r["a"] / 10) * 10, r["b"]] for r in got])
    y = np.array([r["label"] for r in got], dtype=float)
    theta = np.zeros(3)
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (y - p) - 0.1 * theta
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        step = np.linalg.solve(hess, grad)
        theta += step
        if np.abs(step).max() < 1e-8:
            break
    model.bias, model.slope = float(theta[0]), (float(theta[1]), float(theta[2]))
    return model


def _near_hits(model: Model):
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in it:
            labels, terms, near = [], [], []
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                found, tokens = scorer.hits(text)
                seen = {(term[0], bare(w)) for k, term in found for w in tokens[max(0, k - WINDOW) : k] + tokens[k + 1 : k + 1 + WINDOW]}
                for term, w in sorted(seen):
                    labels.append(label)
                    terms.append(term)
                    near.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(terms, pa.string()), pa.array(near, pa.string())], names=["label", "term", "w"])

    return batches


def _evidence(model: Model):
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in it:
            both = [scorer.evidence(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("label"), pa.array([x for x, _ in both], pa.float64()), pa.array([x for _, x in both], pa.float64())], names=["label", "a", "b"])

    return batches


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, score): one per row of ``docs``, 0 to 1. Null and empty texts get the score of no evidence."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for b in it:
            scores = [scorer.score(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(batches, f"doc_id {kind}, score double")


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Rows (doc_id, text, label) to learn from: labelled 0 or 1, outside the held-out third (crc32 mod 3 = 1).

    At most ``fit_rows`` ids and as many rows take part, those with the least hashes. Of several labels of an id the highest counts.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.where(crc_fold(F.col("doc_id")) != 1).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(fit_rows)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted): one per row of ``docs``; labels only of rows outside the held-out third are read.

    A null id is not held out. Null and empty texts get the score of a text without evidence; null labels are none.
    """
    train = written(training_rows(docs, labels), "train")
    out = score(docs, fit(train))
    return out.select(
        "doc_id", F.coalesce(crc_fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))
