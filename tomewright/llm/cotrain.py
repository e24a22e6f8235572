"""Quality classifier by co-training of a text view and a page-metadata view.

The text view sees a text's content: the rates of the rule statistics (symbols, repeated lines and three-word windows,
capitals, marks, word length) and the evidence of its words. The metadata view sees what a page comes with: source,
language, number of words and lines, length of lines, and the evidence of these. Evidence is the mean log odds of a
document's tokens, by how many good and low documents have them (words in WORDS hashed places).

Each view is a logistic regression, fitted on labelled rows, whose own tokens are left out of their evidence. Over some
rounds each view labels all those unlabelled rows of the whole table it is sure of, and the other one's evidence counts
them too, with less weight. Then each view is calibrated (Platt) and the calibrated log odds are combined, both on
labelled rows that neither view was fitted on. A document is rejected under the threshold that loses at most
`good_lost` of those good rows, and never at a score over one half.

At most `limit` labelled rows are fitted on, chosen by hash; labelled rows beyond them count as unlabelled. The exchange
and the scores cover every row; what the driver gets of them are counts for a fixed number of tokens. Null and empty
texts have no words and a rate of 0 throughout; null source and lang are values of their own. Without labelled rows of
both kinds all are kept with score 0.5. Repeated rows are scored alike, null ids like others. An empty table gives no
rows. Only doc_id, text, source and lang are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import FIT_ROWS, labelled, released, slabs, work_table
from tomewright.llm.quality_rules import LONGS, STATS, calibrate, features, rule_stats

#: Hashed places for words, and for tokens of the metadata.
WORDS, META = 1 << 16, 1 << 10
#: Tokens of labelled rows that are looked at together.
SLAB = 1 << 18
#: Weight of a document that a view has labelled, against a labelled one.
TAUGHT = 0.3


def text_view(stats: np.ndarray, evidence: np.ndarray) -> np.ndarray:
    x = features(stats)
    x[:, 0] = np.log1p(x[:, 0])
    return np.column_stack([x, np.sqrt(x), x**2, evidence])


def meta_view(stats: np.ndarray, evidence: np.ndarray) -> np.ndarray:
    n, chars, lines = stats[:, 0], stats[:, 1], stats[:, 5]
    size = np.column_stack([np.log1p(n), np.log1p(lines), np.log1p(chars / np.maximum(lines, 1)), n == 0])
    return np.column_stack([size, size**2, evidence])


def words_in(text: bytes) -> list[int]:
    """The places of a text's different words."""
    return sorted({zlib.crc32(w) % WORDS for w in set(text.lower().split())})


def meta_tokens(stats: np.ndarray, source: list, lang: list) -> np.ndarray:
    """Five places for each row: source, language, and classes of size."""
    name = lambda kind, v: zlib.crc32(f"{kind}\0{'' if v is None else f'v{v}'}".encode()) % META
    n, chars, lines = stats[:, 0], stats[:, 1], stats[:, 5]
    size = [np.floor(2 * np.log2(1 + x)).astype(int) for x in (n, lines, chars / np.maximum(lines, 1))]
    named = [[name(k, v) for v in column] for k, column in (("source", source), ("lang", lang))]
    return np.column_stack([*(np.array(x, int).reshape(-1) for x in named), *([name(f"size{k}", int(v)) for v in x] for k, x in enumerate(size))]).astype(int) if len(stats) else np.zeros((0, 5), int)


def log_odds(good: np.ndarray, low: np.ndarray, n_good: np.ndarray | float, n_low: np.ndarray | float) -> np.ndarray:
    """Smoothed so that a token nobody has tells nothing."""
    n = n_good + n_low
    return np.log((good + n_good / n) / (n_good + 1)) - np.log((low + n_low / n) / (n_low + 1))


def own_evidence(rows: "Rows", view: int, counts: np.ndarray, y: np.ndarray, fit: np.ndarray) -> np.ndarray:
    """The evidence of labelled rows of which the fitted ones are in the counts: a row doesn't testify for itself."""
    ends, tokens = rows.tokens(view)
    (good, low), out = counts, np.zeros(len(y))
    for lo, hi in slabs(np.diff(ends), SLAB):
        own, n = tokens[ends[lo] : ends[hi]], np.diff(ends[lo : hi + 1])
        mine, other = (np.repeat((fit & on)[lo:hi], n) for on in (y, ~y))
        value = log_odds(good[own] - mine, low[own] - other, good[-1] - mine, low[-1] - other)
        out[lo:hi] = means(ends[lo : hi + 1] - ends[lo], value)
    return out


def own_counts(rows: "Rows", view: int, size: int, on: np.ndarray) -> np.ndarray:
    """How many of these rows have each token, and how many there are."""
    ends, tokens = rows.tokens(view)
    out = np.zeros(size + 1)
    out[-1] = on.sum()
    for lo, hi in slabs(np.diff(ends), SLAB):
        out[:-1] += np.bincount(tokens[ends[lo] : ends[hi]][np.repeat(on[lo:hi], np.diff(ends[lo : hi + 1]))], minlength=size)
    return out


def means(ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The mean of each run of values; none: 0. ends: n + 1 offsets."""
    total = np.concatenate([[0.0], np.cumsum(values)])
    return (total[ends[1:]] - total[ends[:-1]]) / np.maximum(np.diff(ends), 1)


@dataclass
class Rows:
    """Documents as the views see them: statistics, metadata tokens, and offsets and places of words."""

    stats: np.ndarray
    meta: np.ndarray
    ends: np.ndarray
    words: np.ndarray

    @classmethod
    def of(cls, columns: dict) -> "Rows":
        """From Arrow columns source, lang, words and the STATS."""
        words = columns["words"]
        words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
        stats = np.column_stack([columns[x].to_numpy() for x in STATS]) if len(words) else np.zeros((0, len(STATS)), int)
        ends = np.asarray(words.offsets).astype(np.int64) if len(words) else np.zeros(1, np.int64)
        flat = words.flatten().to_numpy().astype(np.uint16) if len(words) else np.zeros(0, np.uint16)
        return cls(stats, meta_tokens(stats, columns["source"].to_pylist(), columns["lang"].to_pylist()), ends - ends[0], flat)

    def tokens(self, view: int) -> tuple[np.ndarray, np.ndarray]:
        return (self.ends, self.words) if view == 0 else (np.arange(len(self.meta) + 1) * self.meta.shape[1], self.meta.ravel())

    def view(self, view: int, evidence: np.ndarray) -> np.ndarray:
        return (text_view, meta_view)[view](self.stats, evidence)


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 25) -> "Logistic":
        """Newton steps; standardised columns; the bias isn't penalised."""
        mean, scale = x.mean(0), x.std(0)
        scale[scale < 1e-9] = np.inf  # a constant column tells nothing
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        w, pen = np.zeros(z.shape[1]), np.append(np.full(x.shape[1], ridge), 1e-6)
        total = weight.sum()
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            g = z.T @ (weight * (p - y)) / total + pen * w
            h = (z * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ z / total + np.diag(pen)
            w = w - np.linalg.solve(h, g)
        return cls(mean, scale, w)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1], -30, 30)


@dataclass
class QualityModel:
    views: tuple[Logistic, Logistic] | None
    odds: tuple[np.ndarray, np.ndarray] | None
    mix: Logistic | None
    platt: tuple[Logistic, Logistic] | None
    threshold: float

    def of_view(self, view: int, rows: Rows) -> np.ndarray:
        ends, own = rows.tokens(view)
        return self.views[view].odds(rows.view(view, means(ends, self.odds[view][own])))

    def scores(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined, text and metadata score (1: good)."""
        if not self.mix or not len(rows.stats):
            return (np.full(len(rows.stats), 0.5),) * 3
        one = [p.odds(self.of_view(v, rows)[:, None]) for v, p in enumerate(self.platt)]
        sure = lambda z: 1 / (1 + np.exp(-z))
        return sure(self.mix.odds(np.column_stack(one))), sure(one[0]), sure(one[1])


def with_views(documents: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """keep, source, lang, the STATS and the places of the words of every row."""
    own = documents.select(*keep, "source", "lang", "text")
    names = [*keep, "source", "lang", *STATS, "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                texts = [(x.as_py() or "").encode() for x in part.column(len(keep) + 2)]
                cols = np.array([rule_stats(t) for t in texts], np.int64).reshape(-1, len(STATS)).T
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep) + 2], *(pa.array(c) for c in cols), pa.array([words_in(t) for t in texts], pa.list_(pa.int32()))], names)

    kinds = ", ".join(f"`{k}` {own.schema[k].dataType.simpleString()}" for k in names[: len(keep) + 2])
    return own.mapInArrow(lambda batches: released(run(batches)), f"{kinds}, {LONGS}, words array<int>")


def taught(pool: DataFrame, model: QualityModel, known: list, sure: float) -> list[np.ndarray]:
    """For each view (0: text) the good and low counts by token, the last for all, of rows the other view is sure of.

    known: ids of the labelled rows, which teach nothing more. The counts are summed up by Spark; there are as many as tokens.
    """
    spread = pool.sparkSession.sparkContext.broadcast((model, pa.array(known)))
    size = (WORDS, META)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ids = spread.value
        counts = [np.zeros((2, n + 1), np.int64) for n in size]
        for b in batches:
            rows = Rows.of(dict(zip(b.schema.names, b.columns, strict=True)))
            free = ~np.asarray(pc.is_in(b.column(0), value_set=ids.cast(b.column(0).type)))
            for view in (0, 1):
                p = 1 / (1 + np.exp(-own.of_view(1 - view, rows)))
                ends, tokens = rows.tokens(view)
                for k, on in enumerate((free & (p > sure), free & (p < 1 - sure))):
                    counts[view][k, -1] += on.sum()
                    counts[view][k, :-1] += np.bincount(tokens[np.repeat(on, np.diff(ends))], minlength=size[view])
        for view in (0, 1):
            at = np.flatnonzero(counts[view].any(0))
            for lo in range(0, len(at), 10_000):
                part = at[lo : lo + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), view)), pa.array(part), *(pa.array(c[part]) for c in counts[view])], ["view", "token", "good", "low"])

    sums = pool.mapInArrow(run, "view long, token long, good long, low long").groupBy("view", "token").agg(F.sum("good").alias("good"), F.sum("low").alias("low")).toPandas()
    out = [np.zeros((2, n + 1)) for n in size]
    for view in (0, 1):
        part = sums[sums["view"] == view]
        out[view][:, part.token.to_numpy()] = part[["good", "low"]].to_numpy().T
    return out


def fit_quality(documents: DataFrame, labels: DataFrame, label: str = "quality", limit: int = FIT_ROWS, rounds: int = 3, sure: float = 0.95, good_lost: float = 0.005) -> QualityModel:
    """Co-training: views fitted on a bounded, fixed sample of labelled rows, taught by all unlabelled ones."""
    own = with_views(labelled(documents, labels, label, limit, learn_all=True, keep=("text", "source", "lang")), ("doc_id", "label")).toArrow()
    own = own.sort_by([(x, "ascending") for x in ("doc_id", *STATS, "source", "lang")]).combine_chunks()
    y = own.column("label").to_numpy() > 0 if own.num_rows else np.zeros(0, bool)
    if not y.any() or y.all():
        return QualityModel(None, None, None, None, 0.0)
    rows = Rows.of({x: own.column(x) for x in own.column_names})
    ids = own.column("doc_id").to_pylist()
    del own
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in ids])  # for calibration
    if not y[held].any() or y[held].all() or not y[~held].any() or y[~held].all():
        held[:] = False
    fit = ~held
    counts = [np.array([own_counts(rows, view, size, fit & on) for on in (y, ~y)]) for view, size in enumerate((WORDS, META))]
    pool = work_table(with_views(documents, ("doc_id",)), "views")
    more = [np.zeros_like(c) for c in counts]
    for k in range(rounds + 1):
        views, odds = [], []
        for view in (0, 1):
            every = counts[view] + TAUGHT * more[view]
            odds.append(log_odds(every[0, :-1], every[1, :-1], every[0, -1], every[1, -1]))
            views.append(Logistic.fit(rows.view(view, own_evidence(rows, view, every, y, fit))[fit], y[fit], np.ones(fit.sum())))
        model = QualityModel((views[0], views[1]), (odds[0], odds[1]), None, None, 0.0)
        if k < rounds:
            more = taught(pool, model, sorted(set(ids)), sure)
    cal = held if held.any() else np.ones(len(y), bool)
    one = np.ones(cal.sum())
    each = [model.of_view(v, rows) for v in (0, 1)]
    model.platt = tuple(Logistic.fit(o[cal, None], y[cal], one, 1e-3) for o in each)
    both = np.column_stack([p.odds(o[:, None]) for p, o in zip(model.platt, each, strict=True)])
    model.mix = Logistic.fit(both[cal], y[cal], one, 1e-3)
    score = 1 / (1 + np.exp(-model.mix.odds(both[cal])))
    model.threshold = min(0.5, -calibrate(-score, y[cal], good_lost))
    return model


def keep_quality(documents: DataFrame, model: QualityModel) -> DataFrame:
    """The rows that the model doesn't reject, with all their columns, whatever their names."""
    spread = documents.sparkSession.sparkContext.broadcast(model)
    at = {x: documents.columns.index(x) for x in ("text", "source", "lang")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = spread.value
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                texts = [(x.as_py() or "").encode() for x in part.column(at["text"])]
                cols = np.array([rule_stats(t) for t in texts], np.int64).reshape(-1, len(STATS)).T
                own = {"source": part.column(at["source"]), "lang": part.column(at["lang"]), "words": pa.array([words_in(t) for t in texts], pa.list_(pa.int32()))}
                score, *_ = m.scores(Rows.of(own | {x: pa.array(c) for x, c in zip(STATS, cols, strict=True)}))
                yield part.filter(pa.array(score >= m.threshold))

    return documents.mapInArrow(lambda batches: released(run(batches)), documents.schema)


def score_quality(documents: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score, text_score, meta_score, kept) of every row."""
    spread = documents.sparkSession.sparkContext.broadcast(model)  # numbers for a fixed count of tokens
    views = with_views(documents, ("doc_id",))
    kind = views.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = spread.value
        for b in batches:
            score, text, meta = m.scores(Rows.of(dict(zip(b.schema.names, b.columns, strict=True))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array(text), pa.array(meta), pa.array(score >= m.threshold)], ["doc_id", "score", "text_score", "meta_score", "kept"])

    return views.mapInArrow(run, f"doc_id {kind}, score double, text_score double, meta_score double, kept boolean")
