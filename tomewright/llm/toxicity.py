"""Counterfactual-regularised toxicity classifier.

A logistic regression over the presence of every word found in SUPPORT labelled rows or more. Each weight has a ridge
penalty, the smaller the further the word's share of toxic rows is from the base rate (in standard deviations), and is
fitted with word dropout, so that one word suffices where it should. For every labelled sentence with identity terms
twins are made in which each term is swapped for another of its list, until each has taken each place; the squared
change of the log odds between a sentence and its twins is penalised, so that it doesn't matter which group a sentence
mentions. A term that is in no labelled sentence has no weight, so that it can't move a score at all. Only the number
of labelled rows is bounded.

Words are runs of letters, lower-cased; labels, lang, source and doc_id are no inputs. Null and empty texts get the
score of no words. Without labelled rows of both kinds every score is the smoothed base rate. Repeated rows are
scored alike. Ties between words go to the one first by code point. Only doc_id and text are read for scoring.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import FIT_ROWS, held_out, labelled, slabs, work_table

#: Terms for groups of people, by list; a term is swapped for another of its list.
IDENTITY = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("old", "young", "elderly"),
    ("blind", "deaf", "disabled"),
    ("american", "mexican", "chinese", "african", "european", "indian"),
)
#: Where a term stands: its list, and its number in it.
TERM = {term: (group, k) for group in IDENTITY for k, term in enumerate(group)}
SHIFTS = range(1, max(map(len, IDENTITY)))
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")
#: Labelled rows that a word is found in, at least, to get a weight.
SUPPORT = 3
#: Found words of one step of the fit, about; the steps take the rows in turn.
SLAB = 1 << 19


def words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


@dataclass
class ToxicModel:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, found: set[str]) -> float:
        z = self.bias + sum(self.weights[w] for w in sorted(found & self.weights.keys()))
        return float(1 / (1 + np.exp(-z)))


def fit_weights(found: list[np.ndarray], y: np.ndarray, scale: np.ndarray, swaps: np.ndarray, times: np.ndarray, named: np.ndarray, fairness: float = 10.0, ridge: float = 1.0, drop: float = 0.6, steps: int = 300, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias. found: the words of each row; scale: what a word's weight is held to, zero being likeliest.

    swaps: rows x(sentence) - x(its twin) over the named words, found so many times, whose squared change of log odds is penalised.
    """
    rng, n = np.random.default_rng(seed), len(y)
    parts = []  # rows from and to, the row of each word in them, and the word
    for lo, hi in slabs(np.array([len(f) for f in found]), SLAB):
        parts.append((lo, hi, np.repeat(np.arange(hi - lo), [len(f) for f in found[lo:hi]]), np.concatenate(found[lo:hi])))
    u, b = np.zeros(len(scale)), float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    m, v = np.zeros(len(u) + 1), np.zeros(len(u) + 1)
    for t in range(1, steps + 1):
        w = scale * u
        g = ridge * u / n
        if times.sum():
            g[named] += fairness * scale[named] * (swaps.T @ (times * (swaps @ w[named]))) / times.sum()
        lo, hi, row, word = parts[t % len(parts)]
        on = rng.random(len(word), dtype=np.float32) > drop
        on |= np.bincount(row, on, hi - lo)[row] == 0  # at least as it was
        row, word = row[on], word[on]
        e = (1 / (1 + np.exp(-(np.bincount(row, w[word], hi - lo) + b))) - y[lo:hi]) / (hi - lo)
        g = np.append(g + scale * np.bincount(word, e[row], len(u)), e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * min(0.5, 1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        u, b = u - step[:-1], b - step[-1]
    return scale * u, b


def fit_toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = FIT_ROWS, fairness: float = 10.0) -> ToxicModel:
    """The classifier from at most `limit` labelled rows that aren't held out."""
    own = labelled(documents, labels, label, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, twins = [], []
            for text in b.column(1).to_pylist():
                found.append(sorted(words(text)))
                terms = []
                for s in SENTENCE.split((text or "").lower()):
                    if own := TERM.keys() & set(WORD.findall(s)):
                        terms.append(" ".join(sorted(own)))  # a twin differs in nothing else
                twins.append(terms)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.string())), pa.array(twins, pa.list_(pa.string()))], ["y", "words", "twins"])

    rows = work_table(own.select(F.col("label").cast("long"), "text").mapInArrow(run, "y long, words array<string>, twins array<string>"), "words")
    n, pos = rows.agg(F.count("*"), F.coalesce(F.sum(F.least("y", F.lit(1))), F.lit(0))).first()
    base = ToxicModel(float(np.log((pos + 0.5) / (n - pos + 0.5))))
    if not pos or pos == n:
        return base
    counts = rows.select("y", F.explode("words").alias("w")).groupBy("w").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    top = counts.where((F.col("a") + F.col("b") >= SUPPORT) | F.col("w").isin(*TERM)).toArrow()
    top = top.sort_by("w")
    vocabulary = top.column("w").to_pylist()  # bounded by the labelled rows, as is all below
    a, b, rate = top.column("a").to_numpy(), top.column("b").to_numpy(), pos / n
    scale = np.abs(a - (a + b) * rate) / np.sqrt((a + b) * rate * (1 - rate)) / 3
    spread = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(spread.value)}
        for b in batches:
            own = [sorted(place[w] for w in ws if w in place) for ws in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.list_(pa.int32()))], ["y", "found"])

    slim = rows.select("y", "words").mapInArrow(places, "y long, found array<int>").toArrow().combine_chunks()
    lists = slim.column("found").chunk(0)
    y, found = slim.column("y").to_numpy() > 0, np.split(lists.flatten().to_numpy(), np.asarray(lists.offsets)[1:-1] - lists.offsets[0].as_py())
    order = sorted(range(len(y)), key=lambda i: (zlib.crc32(found[i].tobytes()), found[i].tobytes(), y[i]))  # kinds mixed
    twins = sorted(tuple(r) for r in rows.select(F.explode("twins").alias("terms")).groupBy("terms").count().collect())
    place = {w: i for i, w in enumerate(vocabulary)}
    named = sorted(w for w in TERM if w in place)
    swaps, times = np.zeros((len(twins) * len(SHIFTS), len(named))), np.repeat(np.array([c for _, c in twins], float), len(SHIFTS))
    for k, (terms, _) in enumerate(twins):
        a = set(terms.split(" "))
        for by in SHIFTS:
            b = {TERM[w][0][(TERM[w][1] + by) % len(TERM[w][0])] for w in a}
            swaps[k * len(SHIFTS) + by - 1] = [(w in a) - (w in b) for w in named]
    w, bias = fit_weights([found[i] for i in order], y[order].astype(float), scale, swaps, times, np.array([place[w] for w in named], int), fairness)
    return ToxicModel(float(bias), dict(zip(vocabulary, w.tolist(), strict=True)))


def score_toxicity(documents: DataFrame, model: ToxicModel, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    spread = documents.sparkSession.sparkContext.broadcast(model)  # bounded by the labelled rows
    own = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = spread.value
        for b in batches:
            score = [m.score(words(t.as_py())) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(score, pa.float64()), pa.array([int(s >= threshold) for s in score], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return own.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
