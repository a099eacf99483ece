"""Toxicity: a Levenshtein automaton over a lexicon trie, and context-window scores.

A lexicon is learned from labelled rows: words, and word beginnings, that occur
in toxic documents far more often than chance allows. A trie holds it; the
nondeterministic Levenshtein automaton walks that trie (its states are pairs of
a trie node and the edits spent), made deterministic as words are read, so that
misspelled terms are found in one pass over a word's characters. For each hit a
window of words decides whether it stands in quotation or is abuse: quoted and
unquoted hits, close hits and misspelled hits are counted apart, and a logistic
model over these counts gives the score.

The model is learned from at most ``sample_rows`` labelled rows (those with the
smallest hashes); everything else covers all rows. Labels, language, source and
id are never inputs of a score.

Defined results: null and empty texts have no hits and get the model's lowest
score; rows without a label, or with a null label, are not learned from; of
repeated labels of an id, the largest counts; equal texts get equal scores;
without any labelled rows, or with one class only, the lexicon is empty and the
score is the smoothed rate of toxic labels; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.common import ALNUM, BROADCAST_BYTES, byte_texts, scratch_table

SAMPLE_ROWS = 20_000  # labelled rows that a model is learned from, at most
WINDOW = 12  # words to each side of a hit
PREFIXES = (5, 6, 7)  # lengths of word beginnings that may be terms
CACHE_WORDS = 300_000  # words whose result a worker remembers; it starts afresh beyond that
CACHE_STATES = 100_000  # likewise, states of the automaton

# Quotation marks.
OPENING = "«“„‹‘"
CLOSING = "»”‟›’"
STRAIGHT = '"'
_CURLY = OPENING + CLOSING

FEATURES = ("unquoted", "quoted", "misspelled", "close", "density")
# Where the training rows say nothing, weights stay here: a quoted hit says less than an unquoted one.
PRIOR = np.array([2.0, 0.5, 1.0, 0.5, 0.5])


def allowed_edits(term: str) -> int:
    """Edits within which a term of this length still counts as misspelled."""
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


class LexiconAutomaton:
    """The Levenshtein automaton intersected with the trie of a lexicon.

    ``match(word)`` returns (term index, edits) with the fewest edits, or None.
    Terms that end in ``*`` are beginnings and must match without edits.
    """

    def __init__(self, terms: list[str], fuzzy: list[bool] | None = None):
        self.terms = terms
        fuzzy = fuzzy or [True] * len(terms)
        self.children: list[dict[str, int]] = [{}]
        self.whole: dict[int, int] = {}
        self.beginning: dict[int, int] = {}
        self.limit: list[int] = [0]  # most edits allowed below a node
        for t, term in enumerate(terms):
            body = term.removesuffix("*")
            edits = allowed_edits(body) if body == term and fuzzy[t] else 0
            node = 0
            self.limit[0] = max(self.limit[0], edits)
            for c in body:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.limit.append(0)
                node = self.children[node][c]
                self.limit[node] = max(self.limit[node], edits)
            (self.whole if body == term else self.beginning)[node] = t
        self.edits_of = [allowed_edits(t) if f and not t.endswith("*") else 0 for t, f in zip(terms, fuzzy)]
        self.alphabet = {c for kids in self.children for c in kids}
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.start = self._state(self._closure({(0, 0)}))

    def _closure(self, pairs: set[tuple[int, int]]) -> frozenset:
        """Adds what deleting characters of a term reaches; keeps the fewest edits of each node."""
        best: dict[int, int] = {}
        todo = list(pairs)
        while todo:
            node, e = todo.pop()
            if e > self.limit[node] or best.get(node, 9) <= e:
                continue
            best[node] = e
            todo += [(kid, e + 1) for kid in self.children[node].values()]
        return frozenset(best.items())

    def _state(self, pairs: frozenset) -> int:
        if pairs not in self.states:
            self.states[pairs] = len(self.sets)
            self.sets.append(pairs)
            self.moves.append({})
            found = [(e, self.whole[n]) for n, e in pairs if n in self.whole and e <= self.edits_of[self.whole[n]]]
            self.accepts.append(min(found)[::-1] if found else None)
        return self.states[pairs]

    def _move(self, state: int, c: str) -> int:
        pairs: set[tuple[int, int]] = set()
        for node, e in self.sets[state]:
            for label, kid in self.children[node].items():
                pairs.add((kid, e + (label != c)))
            pairs.add((node, e + 1))
        return self._state(self._closure(pairs))

    def match(self, word: str) -> tuple[int, int] | None:
        if len(self.sets) > CACHE_STATES:
            self._reset()
        state, node, begun = self.start, 0, None
        moves, alphabet = self.moves, self.alphabet
        for c in word:
            if begun is None and node >= 0:
                node = self.children[node].get(c, -1)
                begun = self.beginning.get(node)
            key = c if c in alphabet else ""
            nxt = moves[state].get(key)
            if nxt is None:
                nxt = moves[state][key] = self._move(state, key)
            state = nxt
            if not self.sets[state] and (node < 0 or begun is not None):
                break
        found = self.accepts[state]
        if found and found[1] == 0:
            return found
        return (begun, 0) if begun is not None else found


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased words of letters and digits; curly quotation marks cut words too."""
    low = text.decode().lower()
    if not low.isascii():
        for mark in _CURLY:
            if mark in low:
                low = low.replace(mark, " ")
    return low.encode().translate(ALNUM).split()


@dataclass
class Lexicon:
    """Terms and, per term, whether misspellings count; ``clean``: near words that are no misspellings."""

    terms: list[str]
    fuzzy: list[bool]
    clean: frozenset[bytes] = frozenset()
    known: dict[bytes, tuple[int, int] | None] = field(default_factory=dict, repr=False)
    automaton: LexiconAutomaton | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"terms": self.terms, "fuzzy": self.fuzzy, "clean": self.clean, "known": {}, "automaton": None}

    def look_up(self, words: set[bytes]) -> dict[bytes, tuple[int, int]]:
        """The words that are hits."""
        if self.automaton is None:
            self.automaton = LexiconAutomaton(self.terms, self.fuzzy)
        known, out = self.known, {}
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words:
            try:
                hit = known[w]
            except KeyError:
                hit = self.automaton.match(w.decode()) if self.terms else None
                if hit is not None and hit[1] and w in self.clean:
                    hit = None
                known[w] = hit
            if hit is not None:
                out[w] = hit
        return out


_TOKENS = re.compile(rf'[{_CURLY}{STRAIGHT}]|[^\x00-\x2F\x3A-\x60\x7B-\x7F{_CURLY}]+')


def quoted_flags(tokens: list[str], at: list[int]) -> list[bool]:
    """Whether each place lies in quotation, judged from WINDOW tokens to each side.

    In quotation: the nearest directed mark before opens and one after closes,
    or an odd number of straight marks stands before and some mark after.
    """
    out = []
    for i in at:
        before, after = tokens[max(0, i - WINDOW):i], tokens[i + 1:i + 1 + WINDOW]
        last = next((t for t in reversed(before) if t in _CURLY), "")
        nxt = next((t for t in after if t in _CURLY), "")
        directed = bool(last) and last in OPENING and bool(nxt) and nxt in CLOSING
        out.append(directed or (before.count(STRAIGHT) % 2 == 1 and STRAIGHT in after))
    return out


def context_features(text: bytes, lexicon: Lexicon) -> np.ndarray:
    """FEATURES of one text."""
    words = plain_words(text)
    hits = lexicon.look_up(set(words))
    if not hits:
        return np.zeros(len(FEATURES))
    tokens = _TOKENS.findall(text.decode().lower())
    at = [i for i, t in enumerate(tokens) if t.encode() in hits]
    quoted = quoted_flags(tokens, at)
    exact = [hits[tokens[i].encode()][1] == 0 for i in at]
    free = [i for i, q in zip(at, quoted) if not q]
    close, low = 0, 0
    for high, i in enumerate(free):
        while i - free[low] > WINDOW:
            low += 1
        close = max(close, high - low)
    return np.array([
        math.log1p(sum(e and not q for e, q in zip(exact, quoted))),
        math.log1p(sum(quoted)),
        math.log1p(sum(not e and not q for e, q in zip(exact, quoted))),
        math.log1p(close),
        math.sqrt(len(free) / max(1, len(words))),
    ])


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, text: bytes) -> float:
        return 1.0 / (1.0 + math.exp(-(self.bias + float(context_features(text, self.lexicon) @ self.weights))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample_rows: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(label, text) of at most ``sample_rows`` labelled documents: those whose ids have the smallest hashes."""
    chosen = scratch_table(
        labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(sample_rows), "labelled")
    # 16 bytes a row: within BROADCAST_BYTES for up to 2 million rows.
    side = F.broadcast(chosen) if 16 * sample_rows <= BROADCAST_BYTES else chosen
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return scratch_table(rows.join(side, "_id").select("label", "text"), "sample")


def _tail(p: int, n: int, rate: float) -> float:
    """-log10 of the chance (a bound) of p or more positives among n at the given rate."""
    q = p / n
    if q <= rate:
        return 0.0
    kl = q * math.log(q / rate) + ((1 - q) * math.log((1 - q) / (1 - rate)) if q < 1 else 0.0)
    return n * kl / math.log(10)


def one_of_each(sample: DataFrame) -> DataFrame:
    """The sample with one of (nearly) equal texts, as their common rare words are no evidence.

    Texts that share the smallest hash of their five-word shingles, by either of
    two hashes, count as equal here.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            low: list[tuple[int, int]] = []
            for text in texts:
                words = plain_words(text)
                hashes = [zlib.crc32(b" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4))]
                low.append((min(hashes), min((h * 0x9E3779B1 + 0x7F4A7C15) % 2**32 for h in hashes)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("text"), *(pa.array(x, pa.int64()) for x in zip(*low))],
                names=["label", "text", "a", "b"])

    rows = sample.mapInArrow(sketch, "label int, text string, a long, b long")
    for key in ("a", "b"):
        rows = rows.groupBy(key).agg(F.max_by(F.struct("label", "text", "a", "b"), F.struct("label", "text")).alias(
            "_row")).select("_row.*")
    return rows.select("label", "text")


def learn_lexicon(sample: DataFrame, evidence: float = 6.0, purity: float = 0.8) -> list[str]:
    """Words and word beginnings whose documents are toxic beyond chance.

    Nearly equal texts count once. A term needs ``evidence`` (-log10 of the
    chance of its counts) and a share ``purity`` of toxic documents. A longer
    beginning under a shorter one is left out.
    """

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for label, text in zip(batch.column("label").to_pylist(), byte_texts(batch.column("text"))):
                words = {w.decode() for w in plain_words(text)}
                begun = {w[:k] + "*" for w in words if len(w) > PREFIXES[0] for k in PREFIXES if len(w) > k}
                counts[label].update(words | begun)
            for label, c in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c)), pa.array([label] * len(c), pa.int32()), pa.array(list(c.values()), pa.int64())],
                    names=["term", "label", "n"])

    distinct = scratch_table(one_of_each(sample), "distinct")
    totals = {r["label"]: r["n"] for r in distinct.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    if not pos or not neg:
        return []
    rate = pos / (pos + neg)
    counted = distinct.mapInArrow(terms_of, "term string, label int, n long").groupBy("term").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("p"), F.sum("n").alias("n"))

    def distinctive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [_tail(p, n, rate) >= evidence for p, n in zip(*(batch.column(c).to_pylist() for c in ("p", "n")))]
            yield batch.filter(pa.array(kept, pa.bool_()))

    # Bounded by the sample alone: words, and their beginnings, of at least three of its toxic texts.
    rows = counted.filter((F.col("p") >= 3) & (F.col("p") >= purity * F.col("n"))).mapInArrow(
        distinctive, "term string, p long, n long").orderBy(F.desc("p"), "n", "term").collect()
    good = [r["term"] for r in rows]
    short = {t.removesuffix("*") for t in good if t.endswith("*")}
    covered = lambda body: any(body[:k] in short for k in PREFIXES if k < len(body))
    # Covered words stay, as only whole words match with edits.
    return [t for t in good if not covered(t.removesuffix("*"))] + [
        t for t in good if not t.endswith("*") and covered(t)]


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float = 1.0,
                 steps: int = 50) -> tuple[np.ndarray, float]:
    """Newton steps of logistic regression with weights drawn towards ``prior``; the bias is free."""
    z = np.hstack([x, np.ones((len(x), 1))])
    centre = np.append(prior, 0.0)
    pull = np.append(np.full(len(prior), strength), 1e-3)
    w = np.append(prior, -2.0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + pull * (w - centre)
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(pull)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def learn_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS,
                   id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Lexicon and weights from the labelled rows of ``docs`` (bounded by ``sample_rows``)."""
    sample = labelled_sample(docs, labels, label, sample_rows, id_col, text_col)
    terms = learn_lexicon(sample)
    lexicon = Lexicon(terms, [True] * len(terms))
    if terms:
        lexicon.clean = _clean_spellings(sample, lexicon)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [context_features(t, lexicon).tolist() for t in byte_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    rows = sample.mapInArrow(features, "label int, x array<double>").groupBy("label", "x").count().collect()
    if not rows:
        return ToxicityModel(lexicon, np.zeros(len(FEATURES)), math.log(0.5 / 1.5))
    n = np.array([r["count"] for r in rows])
    x = np.repeat(np.array([r["x"] for r in rows]), n, axis=0)
    y = np.repeat(np.array([r["label"] for r in rows], dtype=float), n)
    if not terms:
        rate = (y.sum() + 0.5) / (len(y) + 1.0)
        return ToxicityModel(lexicon, np.zeros(len(FEATURES)), math.log(rate / (1 - rate)))
    weights, bias = fit_logistic(x, y, PRIOR)
    return ToxicityModel(lexicon, np.maximum(weights, 0.0), bias)


def _clean_spellings(sample: DataFrame, lexicon: Lexicon, purity: float = 0.8, evidence: float = 1.0) -> frozenset[bytes]:
    """Near words of the lexicon's terms that are words of clean texts, not misspellings.

    A near word is judged by the texts that hold it and no exact term, of nearly
    equal ones one: it is clean if their labels are 10^``evidence`` times likelier
    at the toxic share of all texts without an exact term than at ``purity``. One
    text is never enough.
    """

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for label, text in zip(batch.column("label").to_pylist(), byte_texts(batch.column("text"))):
                hits = lexicon.look_up(set(plain_words(text)))
                if all(e for _, e in hits.values()):
                    seen[label].update(list(hits) + [b""])  # the empty word counts the texts
            for label, c in seen.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.binary()), pa.array([label] * len(c), pa.int32()),
                     pa.array(list(c.values()), pa.int64())], names=["word", "label", "n"])

    counted = scratch_table(one_of_each(sample).mapInArrow(near, "word binary, label int, n long").groupBy("word").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("p"), F.sum("n").alias("n")), "near_words")
    texts = counted.filter(F.length("word") == 0).first()
    if texts is None:
        return frozenset()
    rate = min(0.5, (texts["p"] + 0.5) / (texts["n"] + 1.0))
    odds = F.col("p") * math.log10(rate / purity) + (F.col("n") - F.col("p")) * math.log10((1 - rate) / (1 - purity))
    # At most the near words of SAMPLE_ROWS texts.
    found = counted.filter((F.length("word") > 0) & (F.col("n") > 1) & (odds >= evidence)).select("word").collect()
    return frozenset(bytes(r["word"]) for r in found)


def toxicity_score(model: ToxicityModel, text_col: str = "text") -> F.Column:
    """The score of a text column, 0 to 1."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t) for t in byte_texts(texts)], pa.float64())

    return score(F.col(text_col))


def reject_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns."""
    return docs.filter(toxicity_score(model, text_col) < threshold)
