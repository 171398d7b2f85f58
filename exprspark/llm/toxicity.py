"""Toxicity by a lexicon trie met with Levenshtein automata, and context windows around each hit.

The lexicon is learned: words that occur in enough toxic and hardly any other documents of a bounded labelled
sample. Its trie and the Levenshtein automaton of one edit are intersected as one automaton whose states are sets of
(trie node, edits used); states are built when first reached and kept, so a word is walked letter by letter and most
words leave the automaton after a few. A hit is weighed by its term, by its exactness, by other hits near it (abuse
comes in clusters) and by quotation marks that enclose it (a quoted term is mentioned rather than used). A small
logistic model over the sums of these weights gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.llm.batches import parts
from exprspark.llm.labelled import held_out, logistic, sigmoid, training_sample
from exprspark.llm.words import split_words

SAMPLE_ROWS = 8_000
TERMS = 1_024
LEAST_DOCS = 4
LEAST_SHARE = 0.9
FUZZY_LENGTH = 5
QUOTE_WINDOW = 4
NEAR_WINDOW = 10
KNOWN_STATES = 200_000
KNOWN_WORDS = 300_000
THRESHOLD = 0.5
FEATURES = 6

# Marks that open or close a quotation, and what is stripped from a word before it is looked up.
QUOTES = "\"'`‘’‚“”„«»‹›"
STRIPPED = QUOTES + ".,;:!?()[]{}<>*_~-…¡¿"


@dataclass
class ToxicModel:
    """Terms with their log-odds weights, look-alikes known to be harmless, and the logistic coefficients."""

    weights: dict[str, float]
    harmless: set[str] = field(default_factory=set)
    coef: np.ndarray = field(default_factory=lambda: np.array([0.0] * (FEATURES - 1) + [-20.0]))


class TermAutomaton:
    """Words within one edit of a trie's terms.

    A state is a set of (node, edits). Reading a letter moves along the trie, or spends the edit on an extra letter (stay),
    another letter (any child) or a missing one (a child without reading).
    """

    def __init__(self, weights: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        for word in sorted(weights):
            node = 0
            for letter in word:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                node = self.children[node][letter]
            self.term[node] = word
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.start = self.number(frozenset({(0, 0)} | {(c, 1) for c in self.children[0].values()}))

    def number(self, state: frozenset) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return self.numbers[state]

    def move(self, at: int, letter: str) -> int:
        """-1: no term is within reach any more."""
        reached = set()
        for node, edits in self.states[at]:
            child = self.children[node].get(letter)
            if child is not None:
                reached.add((child, edits))
                if not edits:
                    reached.update((c, 1) for c in self.children[child].values())
            if not edits:
                reached.add((node, 1))
                reached.update((c, 1) for c in self.children[node].values())
        to = self.number(frozenset(reached)) if reached else -1
        self.moves[at][letter] = to
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its distance; ties by alphabet. Short terms must match exactly."""
        if len(self.states) > KNOWN_STATES:
            self.forget()
        at = self.start
        for letter in word:
            to = self.moves[at].get(letter)
            at = self.move(at, letter) if to is None else to
            if at < 0:
                return None
        found = [
            (edits, self.term[node]) for node, edits in self.states[at]
            if self.term[node] is not None and (not edits or min(len(word), len(self.term[node])) >= FUZZY_LENGTH)
        ]
        if not found:
            return None
        edits, term = min(found)
        return term, edits


class ToxicScorer:
    """Features of whole texts; words are classified once and remembered up to a bound."""

    def __init__(self, model: ToxicModel):
        self.model = model
        self.automaton = TermAutomaton(model.weights)
        self.known: dict[str, tuple[float, bool] | None] = {}

    def hit(self, word: str) -> tuple[float, bool] | None:
        """Weight and exactness of a word as it stands in a text."""
        bare = word.lower().strip(STRIPPED)
        if not bare or bare in self.model.harmless:
            return None
        found = self.automaton.match(bare)
        return None if found is None else (self.model.weights[found[0]], found[1] == 0)

    def features(self, texts: pa.Array) -> np.ndarray:
        """One row per text: sums over exact, misspelled and quoted hits, the largest hit, their density, a constant."""
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        vocabulary = coded.dictionary.to_pylist()
        if len(self.known) + len(vocabulary) > KNOWN_WORDS:
            self.known.clear()
        known = self.known
        for word in vocabulary:
            if word not in known:
                known[word] = self.hit(word)
        hits = np.array([known[w] is not None for w in vocabulary], dtype=bool)
        index = coded.indices.to_numpy(zero_copy_only=False)
        bounds = words.offsets.to_numpy()
        out = np.zeros((len(texts), FEATURES))
        out[:, -1] = 1.0
        places = np.flatnonzero(hits[index]) if len(index) else np.empty(0, dtype=np.int64)
        for doc, own in grouped(places, bounds):
            out[doc, :-1] = self.context([vocabulary[i] for i in index[bounds[doc] : bounds[doc + 1]]], own - bounds[doc])
        return out

    def context(self, words: list[str], places: np.ndarray) -> list[float]:
        exact = fuzzy = quoted = largest = 0.0
        for k, place in enumerate(places):
            weight, same = self.known[words[place]]
            near = np.searchsorted(places, place + NEAR_WINDOW, "right") - np.searchsorted(places, place - NEAR_WINDOW)
            weight *= 1.0 + 0.25 * min(int(near) - 1, 4)
            if within_quotes(words, int(place)):
                quoted += weight
                continue
            largest = max(largest, weight if same else 0.5 * weight)
            exact, fuzzy = (exact + weight, fuzzy) if same else (exact, fuzzy + weight)
        density = (exact + fuzzy) / np.sqrt(len(words))
        return [np.log1p(exact), np.log1p(fuzzy), np.log1p(quoted), largest, np.log1p(density)]


def within_quotes(words: list[str], place: int) -> bool:
    """A quotation mark opens at or shortly before the word and one closes at or shortly after it."""
    before = any(w[:1] in QUOTES for w in words[max(0, place - QUOTE_WINDOW) : place + 1] if w)
    after = any(w.rstrip(".,;:!?)")[-1:] in QUOTES for w in words[place : place + QUOTE_WINDOW + 1] if w.rstrip(".,;:!?)"))
    return before and after


def grouped(places: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each text that has hits, with the places of these."""
    docs = np.searchsorted(bounds, places, side="right") - 1
    for doc in np.unique(docs):
        yield int(doc), places[docs == doc] if len(docs) < 64 else places[np.searchsorted(docs, doc) : np.searchsorted(docs, doc, "right")]


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, terms: int = TERMS) -> ToxicModel:
    """A model from at most ``rows`` labelled documents outside the held-out fold; without toxic ones it scores zero."""
    sample = training_sample(docs, labels, "toxic", rows).select("text", "label")
    words = F.array_distinct(F.transform(split_words(F.lower("text")), lambda w: F.trim(w, F.lit(STRIPPED))))
    counts = (
        sample.select("label", F.explode(words).alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("toxic"), F.sum(F.lit(1) - F.col("label")).alias("clean"))
        .filter(F.col("word") != "")
    )
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    top = counts.filter((F.col("toxic") >= LEAST_DOCS) & (share >= LEAST_SHARE) & (F.length("word") >= 3))
    top = top.orderBy(F.desc("toxic"), "clean", "word").limit(terms).collect()
    if not top:
        return ToxicModel({})
    weights = {r["word"]: float(np.log((r["toxic"] + 0.5) / (r["clean"] + 0.5))) for r in top}
    # Words of clean sample documents that look like a term are no misspellings of it; the sample bounds their number.
    shape = TermAutomaton(weights)

    @F.pandas_udf("boolean")
    def alike(w):
        return w.map(lambda x: shape.match(x) is not None)

    clean = counts.filter((F.col("clean") >= 1) & (F.col("clean") >= F.col("toxic"))).filter(alike("word")).select("word")
    model = ToxicModel(weights, {r["word"] for r in clean.collect()} - set(weights))
    found = sample.mapInArrow(lambda b: feature_rows(model, b), f"label int, f array<double>").toArrow()
    features = np.array(found["f"].to_pylist(), dtype=float).reshape(-1, FEATURES)
    model.coef = logistic(features, found["label"].to_numpy().astype(float))
    return model


def feature_rows(model: ToxicModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scorer = ToxicScorer(model)
    for texts, label in parts(batches, 0):
        yield pa.RecordBatch.from_arrays([label, pa.array(list(scorer.features(texts)), pa.list_(pa.float64()))], names=["label", "f"])


def score(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    NULL and empty texts have no hits and get the score of such a text; repeated rows score alike; a NULL id is not held
    out; other columns play no part; an empty table gives an empty result. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = ToxicScorer(model)
        for doc_ids, held, texts in parts(batches, 2):
            p = sigmoid(scorer.features(texts) @ model.coef)
            yield pa.RecordBatch.from_arrays(
                [doc_ids, held, pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their columns as they are."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = ToxicScorer(model)
        for batch in batches:
            kept = [sigmoid(scorer.features(columns[at]) @ model.coef) < threshold for columns in parts(iter([batch]), at)]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, docs.schema)
