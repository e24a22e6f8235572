"""Quality rules and an isolation forest on their statistics.

Every text gives rule statistics (words, symbols, repeated lines, repeated three-word windows, ...). Hard rules fail
a document at once. An isolation forest is grown on the statistics of labelled good rows: random splits, and a row
that lies outside the range of a node's rows is isolated there. A document's anomaly score comes from its mean path
length. The score above which a document is dropped is calibrated on labelled rows that the forest hasn't seen: no
more than `good_lost` of the good ones are above it. Only the number of labelled rows is bounded.

Words are `[^\\x20\\x09-\\x0D]+`. A null or empty text has no words, so it fails the rules. Repeated rows are judged one
by one, alike, null ids like others. Without labelled rows of both kinds the forest drops nothing. Only doc_id and
text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import work_table

SYMBOLS, SPACES = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
UPPER, CONTINUATION = bytes(range(65, 91)), bytes(range(128, 192))
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
LONGS = ", ".join(f"{x} long" for x in STATS)


def rule_stats(text: bytes) -> tuple[int, ...]:
    """The STATS of one text in UTF-8."""
    words = text.split()  # bytes: exactly the six ASCII spaces
    n = len(words)
    chars = len(text.translate(None, SPACES + CONTINUATION))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeat = 0
    if n > 3:
        runs = list(zip(words, words[1:], words[2:], strict=False))
        seen, twice = set(), set()
        if len(set(runs)) < len(runs):
            for r in runs:
                if r in seen:
                    twice.add(r)
                seen.add(r)
            hit = np.fromiter((r in twice for r in runs), bool, n - 2)
            over = np.zeros(n, bool)
            for k in range(3):
                over[k : k + n - 2] |= hit
            repeat = int(over.sum())
    without = lambda chars: len(text) - len(text.translate(None, chars))
    return n, chars, without(SYMBOLS), len(lines) - len(set(lines)), repeat, len(lines), without(UPPER), without(b"!?")


#: Words of an ordinary text that are added to each text, so that the rates of short ones don't stray.
PRIOR = 50


def features(stats: np.ndarray) -> np.ndarray:
    """Rates that don't depend on a text's length."""
    n, chars, symbols, dup, repeat, lines, upper, marks = stats.T.astype(float)
    words, letters = n + PRIOR, chars + 5 * PRIOR
    return np.column_stack([letters / words, symbols / letters, dup / (lines + PRIOR / 20), repeat / words, upper / letters, marks / words])


@dataclass
class IsolationForest:
    """Trees as flat arrays: for node k a feature (-1: leaf), its least, split and largest value, the left child, and a depth."""

    trees: list[tuple[np.ndarray, ...]]
    usual: float

    @staticmethod
    def mean_path(n: float) -> float:
        """Mean path length of an unsuccessful search in a random binary tree of n points."""
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    @classmethod
    def grow(cls, x: np.ndarray, trees: int = 200, sample: int = 256, seed: int = 7) -> "IsolationForest":
        rng, out = np.random.default_rng(seed), []
        size = min(sample, len(x))
        deepest = np.ceil(np.log2(max(size, 2)))
        for _ in range(trees):
            nodes: list[tuple] = []
            todo = [(x[rng.choice(len(x), size, replace=False)], 0)]
            while todo:  # breadth first: children stand side by side
                after: list[tuple] = []
                first = len(nodes) + len(todo)
                for rows, d in todo:
                    if len(rows) < 2 or d >= deepest:
                        nodes.append((-1, 0.0, 0.0, 0.0, 0, d + cls.mean_path(len(rows))))
                        continue
                    f = int(rng.integers(x.shape[1]))
                    low, high = rows[:, f].min(), rows[:, f].max()
                    at = rng.uniform(low, high)
                    nodes.append((f, low, at, high, first + len(after), d + 1.0))
                    over = rows[:, f] > at
                    after += [(rows[~over], d + 1), (rows[over], d + 1)]
                todo = after
            out.append(tuple(np.array(column) for column in zip(*nodes, strict=True)))
        return cls(out, cls.mean_path(size) or 1.0)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Near 1: isolated by few splits; about 0.5 and less: ordinary."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, low, value, high, left, depth in self.trees:
            at, on = np.zeros(len(x), int), np.ones(len(x), bool)
            while (on := on & (feature[at] >= 0)).any():
                own = x[rows, np.maximum(feature[at], 0)]
                on &= (own >= low[at]) & (own <= high[at])  # beyond the range: isolated here
                at = np.where(on, left[at] + (own > value[at]), at)
            total += depth[at]
        return 2.0 ** (-total / len(self.trees) / self.usual)


def calibrate(scores: np.ndarray, good: np.ndarray, good_lost: float) -> float:
    """The lowest threshold above which at most good_lost of the good rows lie; infinite without rows of both kinds."""
    if not good.any() or good.all():
        return float("inf")
    own = np.sort(scores[good])
    return float(own[min(len(own) - 1, int(np.ceil(len(own) * (1 - good_lost))))])


@dataclass
class RuleModel:
    forest: IsolationForest | None
    threshold: float

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return self.forest.score(features(stats)) if self.forest and len(stats) else np.zeros(len(stats))


def with_stats(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep and the STATS of every row."""
    own = documents.select(*keep, "text")
    fields = [*keep, *STATS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [rule_stats((x.as_py() or "").encode()) for x in b.column(len(keep))]
            cols = np.array(rows, np.int64).reshape(-1, len(STATS)).T
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *(pa.array(c) for c in cols)], fields)

    kinds = ", ".join(f"`{k}` {own.schema[k].dataType.simpleString()}" for k in keep)
    return own.mapInArrow(run, f"{kinds}, {LONGS}")


#: Trees of the forest, and splits on the way to their deepest nodes.
TREES, DEEPEST = 200, 8


def _by_batch(rows: DataFrame, run, kind: str) -> DataFrame:
    """run(statistics) of each batch of rows with STATS, as columns of `kind`."""
    names = [x.split()[0] for x in kind.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cols = run(np.column_stack([c.to_numpy() for c in b.columns]))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names)

    return rows.select(*STATS).mapInArrow(each, kind)


def grow_over(rows: DataFrame, n: int, seed: int = 7) -> IsolationForest:
    """A forest whose trees are all grown from all n rows (with STATS), one pass a level.

    Node k has the children 2k + 1 and 2k + 2. A pass counts each node's rows and finds the range of its feature; the
    driver gets these figures only, whose number doesn't depend on the rows.
    """
    rng, size = np.random.default_rng(seed), 2 ** (DEEPEST + 1) - 1
    chosen, share = rng.integers(features(np.zeros((1, len(STATS)))).shape[1], size=(TREES, size)), rng.uniform(size=(TREES, size))
    feature, depth = np.full((TREES, size), -1), np.zeros((TREES, size))
    low, split, high = (np.zeros((TREES, size)) for _ in range(3))
    for d in range(DEEPEST + 1):
        first, width = 2**d - 1, 2**d
        model = rows.sparkSession.sparkContext.broadcast((feature, split, chosen))

        def run(stats: np.ndarray, d=d, first=first, width=width, model=model):
            own, cut, chosen = model.value
            x, at_row, found = features(stats), np.arange(len(stats)), []
            for t in range(TREES):
                at = np.zeros(len(x), int)
                for _ in range(d):
                    f = own[t, at]
                    at = np.where(f >= 0, 2 * at + 1 + (x[at_row, np.maximum(f, 0)] > cut[t, at]), at)
                here = np.flatnonzero(at >= first)
                v, node = x[here, chosen[t, at[here]]], at[here] - first
                least, most = np.full(width, np.inf), np.full(width, -np.inf)
                np.minimum.at(least, node, v)
                np.maximum.at(most, node, v)
                count = np.bincount(node, minlength=width)
                has = np.flatnonzero(count)
                found.append((np.full(len(has), t), has + first, count[has], least[has], most[has]))
            return [np.concatenate(c) for c in zip(*found, strict=True)]

        parts = _by_batch(rows, run, "tree long, node long, n long, least double, most double")
        got = parts.groupBy("tree", "node").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")).toPandas()
        model.unpersist()
        count = np.zeros((TREES, size), int)
        t, k = got.tree.to_numpy(), got.node.to_numpy()
        count[t, k], low[t, k], high[t, k] = got.n, got.least, got.most
        level = slice(first, first + width)
        inner = (count[:, level] >= 2) & (d < DEEPEST)
        feature[:, level] = np.where(inner, chosen[:, level], -1)
        split[:, level] = low[:, level] + share[:, level] * (high[:, level] - low[:, level])
        depth[:, level] = d + np.where(inner, 1.0, [[IsolationForest.mean_path(c) for c in r] for r in count[:, level]])
    left = 2 * np.arange(size) + 1
    return IsolationForest([(feature[t], low[t], split[t], high[t], left, depth[t]) for t in range(TREES)], IsolationForest.mean_path(n) or 1.0)


def fit_rules(documents: DataFrame, labels: DataFrame, label: str = "quality", good_lost: float = 0.005, stats: DataFrame | None = None) -> RuleModel:
    """The forest and its threshold from all labelled rows (1: good): it is grown on half of the good ones, by their ids.

    stats: with_stats(documents), where it is at hand. Of several labels of an id the largest holds; rows with a null id
    or label are left out.
    """
    own = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    own = own.groupBy("doc_id").agg(F.max("label").alias("label"))
    seen = (F.col("label") > 0) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)
    rows = work_table((with_stats(documents) if stats is None else stats).join(own, "doc_id").withColumn("seen", seen), "labelled")
    n = rows.agg(F.count_if("seen").alias("seen"), F.count_if(F.expr("label > 0 and not seen")).alias("good"), F.count_if(F.expr("label <= 0")).alias("low")).first()
    if n.seen < 2 or not n.low:
        return RuleModel(None, float("inf"))
    forest = grow_over(rows.where("seen"), n.seen)
    if not n.good:
        return RuleModel(forest, float("inf"))
    spread = documents.sparkSession.sparkContext.broadcast(forest)
    scores = _by_batch(rows.where("label > 0 and not seen"), lambda s: [spread.value.score(features(s))], "score double")
    above = n.good - min(n.good - 1, int(np.ceil(n.good * (1 - good_lost))))
    return RuleModel(forest, scores.orderBy(F.desc("score")).limit(above).agg(F.min("score")).first()[0])


def apply_rules(documents: DataFrame, model: RuleModel, min_words: int = 50, max_repeat_pct: int = 50, stats: DataFrame | None = None) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept and anomaly of every row. stats: with_stats(documents), where it is at hand."""
    spread = documents.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers, whatever the input
    stats = with_stats(documents) if stats is None else stats
    kind = stats.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = spread.value
        for b in batches:
            s = np.column_stack([b.column(1 + k).to_numpy() for k in range(len(STATS))]) if b.num_rows else np.zeros((0, len(STATS)), int)
            failed = (s[:, 0] < min_words) | (100 * s[:, 4] > max_repeat_pct * s[:, 0])
            odd = own.scores(s)
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(failed), pa.array(~failed & (odd <= own.threshold)), pa.array(odd)], ["doc_id", *STATS[:5], "base_failed", "kept", "anomaly"])

    return stats.mapInArrow(run, f"doc_id {kind}, {', '.join(f'{x} long' for x in STATS[:5])}, base_failed boolean, kept boolean, anomaly double")
