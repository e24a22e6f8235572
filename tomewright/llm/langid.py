"""Language identification by interpolated Kneser-Ney character models.

Each language gets a character model of order four from all labelled documents that aren't held out. The corpus is
counted where it lies, each task sends its distinct four-grams, and lower orders follow from them, as Kneser-Ney
counts in how many contexts a gram is found; probabilities and back-off weights are joined together as tables, so that no
task needs a whole language. They become two files, keys and values: for each language and order a sorted array of
64-bit keys beside their log probabilities, and one of contexts beside their weights. Executors fetch the files once
and map them into memory; nothing is pruned and no language is left out. A text's distinct grams are looked up by
binary search, and those that aren't found fall back to the next order with the weight of their context. A text's
language is that of the least cross-entropy per character, its score the softmax over those entropies with a
temperature. Temperature, and the score under which a row is marked `rejected`, are calibrated on rows that weren't
counted: one in fifty is set aside by hash, and about CALIBRATION_ROWS of those are used. A language all of whose rows
would be set aside is counted from all of them.

Characters are lower-cased; what isn't a letter becomes one space. A key packs four 16-bit codes, so it has no
collisions; letters over U+FFFF share the 8,448 codes that aren't characters. Null texts and texts without a letter are
`und` with score 0. A language without text has no model; without any, everything is `und`. Ties go to the name first
by code point. Repeated rows count as often as they are found; rows with a null id are held out. Only doc_id, text and
lang are read, lang only for learning, and other columns may have any name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import held_out, shared_dir, work_table

ORDER, DISCOUNT = 4, 0.75
#: Share of the rows that may be learned from that is set aside, and how many of them calibrate, about.
ASIDE, CALIBRATION_ROWS = 0.02, 2000
#: Characters that are looked up in one go.
SLAB = 1 << 18
#: Codes for letters over U+FFFF: surrogates and private use, which no text has as letters.
FAR, FAR_CODES = 0xD800, 0xF900 - 0xD800
#: Keys of a row of the packed model.
PACK = 1 << 16
U = np.uint64
_table = np.zeros(0, np.uint16)


def _codes() -> np.ndarray:
    """Code point to code: a lower-case letter is itself, all else a space."""
    global _table
    if not len(_table):
        _table = np.array([ord(c.lower()[0]) if (c := chr(i)).isalpha() else 32 for i in range(1 << 16)], np.uint16)
    return _table


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts, each led by three spaces; a text's offset; whether it has a letter."""
    raw = np.frombuffer("".join(f"   {t or ''}" for t in texts).encode("utf-32-le", "replace"), np.uint32)
    codes = _codes()[np.minimum(raw, 0xFFFF)]
    far = np.flatnonzero(raw > 0xFFFF)
    if len(far):
        points, back = np.unique(raw[far], return_inverse=True)
        own = [FAR + ord(c.lower()[0]) % FAR_CODES if (c := chr(int(i))).isalpha() else 32 for i in points]
        codes[far] = np.array(own, np.uint16)[back]
    sizes = np.array([len(t or "") + 3 for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    letters = np.concatenate([[0], np.cumsum(codes != 32)])
    return codes, offsets, letters[offsets[1:]] > letters[offsets[:-1]]


def grams(codes: np.ndarray) -> np.ndarray:
    """The key of each run of four codes; the latest is in the low bits."""
    c = codes.astype(np.uint64)
    two = (c[:-1] << U(16)) | c[1:]
    return (two[:-2] << U(32)) | two[2:]


def _inner(offsets: np.ndarray, total: int) -> np.ndarray:
    """Which grams lie within one text, by their first code."""
    inside = np.ones(max(0, total - 3), bool)
    for k in range(1, 4):
        cut = offsets[1:-1] - k
        inside[cut[(cut >= 0) & (cut < len(inside))]] = False
    return inside


def _cut(texts: list[str | None]) -> Iterator[list[int]]:
    """Indices of texts of about SLAB characters in all."""
    own, size = [], 0
    for i, t in enumerate(texts):
        own.append(i)
        size += len(t or "") + 3
        if size >= SLAB:
            yield own
            own, size = [], 0
    if own:
        yield own


def learnable(documents: DataFrame) -> DataFrame:
    """(lang, text, place) of all rows that may be learned from; place: a number in [0, 1) by hash, under ASIDE for calibration."""
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text", place.alias("place"))


def count_grams(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows (lang, text)."""
    own = rows.select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def fold(lang: str) -> tuple[np.ndarray, np.ndarray]:
            keys, n = (np.concatenate(x) for x in zip(*held[lang], strict=True))
            order = np.argsort(keys)
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
            held[lang] = [(keys[first], np.add.reduceat(n, first) if len(first) else n)]
            return held[lang][0]

        for b in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                for part in _cut(texts):
                    codes, offsets, _ = encode([texts[i] for i in part])
                    held.setdefault(lang, []).append(np.unique(grams(codes)[_inner(offsets, len(codes))], return_counts=True))
                    if len(held[lang]) >= 16:
                        fold(lang)
        for lang in held:
            keys, n = fold(lang)
            for at in range(0, len(keys), 50_000):
                k = keys[at : at + 50_000].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), pa.array(k), pa.array(n[at : at + 50_000])], ["lang", "gram", "n"])

    counts = own.mapInArrow(run, "lang string, gram long, n long")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def estimate(counts: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """(lang, part, key, value) from four-gram counts (lang, gram, n): interpolated Kneser-Ney.

    Part 2 * order - 2: log probabilities of grams; part 2 * order - 1: log weights of contexts. Part 8: the log
    probability of a character that no language has, under key 0.
    """
    mask = lambda order: F.col("gram").bitwiseAND(F.lit((1 << (16 * order)) - 1))
    levels = {ORDER: counts.select("lang", "gram", F.col("n").cast("double"))}
    for order in range(ORDER - 1, 0, -1):
        levels[order] = levels[order + 1].select("lang", mask(order).alias("gram")).groupBy("lang", "gram").agg(F.count("*").cast("double").alias("n"))
    kinds = levels[1].agg(F.count_distinct("gram")).first()[0] + 1  # at most as many as there are codes
    out, below = [], None
    for order in range(1, ORDER + 1):
        context = F.shiftrightunsigned("gram", 16) if order > 1 else F.lit(0).cast("long")
        grams = levels[order].withColumn("context", context)
        weights = grams.groupBy("lang", "context").agg(F.sum("n").alias("total"), (discount * F.count("*") / F.sum("n")).alias("weight"))
        grams = grams.join(weights, ["lang", "context"])
        own = F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total")
        if below is None:
            grams = grams.select("lang", "gram", (own + F.col("weight") / kinds).alias("p"))
            out.append(weights.select("lang", F.lit(2 * ORDER).alias("part"), F.lit(0).cast("long").alias("key"), F.log(F.col("weight") / kinds).alias("value")))
        else:
            lower = below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            grams = grams.withColumn("suffix", mask(order - 1)).join(lower, ["lang", "suffix"]).select("lang", "gram", (own + F.col("weight") * F.col("lower")).alias("p"))
        below = work_table(grams, f"order-{order}")
        out.append(below.select("lang", F.lit(2 * order - 2).alias("part"), F.col("gram").alias("key"), F.log("p").alias("value")))
        out.append(weights.select("lang", F.lit(2 * order - 1).alias("part"), F.col("context").alias("key"), F.log("weight").alias("value")))
    return reduce(DataFrame.unionByName, out)


def packed(table: DataFrame) -> DataFrame:
    """(lang, part, first, n, keys, values): the table in order of lang, part and key, at most PACK keys a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, part = np.array(b.column(0).to_pylist(), object), b.column(1).to_numpy()
            keys, values = b.column(2).to_numpy(), b.column(3).to_numpy().astype("<f4")
            edge = np.flatnonzero((lang[1:] != lang[:-1]) | (part[1:] != part[:-1])) + 1
            rows = []
            for lo, hi in zip([0, *edge], [*edge, len(keys)], strict=True):
                for s in range(lo, hi, PACK):
                    e = min(s + PACK, hi)
                    rows.append((lang[s], int(part[s]), int(keys[s]), e - s, keys[s:e].astype("<i8").tobytes(), values[s:e].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["lang", "part", "first", "n", "keys", "values"]) if rows else b.slice(0, 0)

    ordered = table.select("lang", F.col("part").cast("int"), "key", F.col("value").cast("double")).orderBy("lang", "part", "key")
    return ordered.mapInArrow(run, "lang string, part int, first long, n long, keys binary, values binary")


@lru_cache(maxsize=4)
def _mapped(keys: str, values: str) -> tuple[np.ndarray, np.ndarray]:
    return np.memmap(SparkFiles.get(keys), "<i8", "r"), np.memmap(SparkFiles.get(values), "<f4", "r")


@dataclass
class Model:
    """Where each language's arrays stand in the two files; a few numbers a language."""

    langs: list[str]
    files: tuple[str, str] = ("", "")
    #: For each language the begin of each of its parts, and their end.
    parts: list[list[int]] = field(default_factory=list)
    unseen: list[float] = field(default_factory=list)
    temperature: float = 1.0
    least: float = 0.0

    def per_char(self, lang: int, grams: np.ndarray) -> np.ndarray:
        """Log probability of the last code of each gram in a language."""
        keys, values = _mapped(*self.files)
        array = lambda part: (keys[slice(*self.parts[lang][part : part + 2])], values[slice(*self.parts[lang][part : part + 2])])
        out, todo = np.zeros(len(grams), np.float64), np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            own = (grams[todo] & U((1 << (16 * order)) - 1)).view(np.int64)
            known, logp = array(2 * order - 2)
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            hit = known[at] == own
            out[todo[hit]] += logp[at[hit]]
            todo = todo[~hit]
            if not len(todo):
                return out
            if order > 1:
                own = ((grams[todo] & U((1 << (16 * order)) - 1)) >> U(16)).view(np.int64)
                known, weight = array(2 * order - 1)
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                hit = known[at] == own
                out[todo[hit]] += weight[at[hit]]
        out[todo] += self.unseen[lang]
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character in every language, and whether a text has a letter."""
        total, some = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), bool)
        for part in _cut(texts):
            codes, offsets, has = encode([texts[i] for i in part])
            some[part] = has
            for lo in range(0, max(0, len(codes) - 3), SLAB):  # a very long text takes several turns
                kinds, back = np.unique(grams(codes[lo : lo + SLAB + 3]), return_inverse=True)
                begin = np.clip(offsets[:-1] - lo, 0, len(back))
                end = np.maximum(np.clip(offsets[1:] - 3 - lo, 0, len(back)), begin)
                for lang in range(len(self.langs)):
                    run = np.concatenate([[0.0], np.cumsum(self.per_char(lang, kinds)[back])])
                    total[part, lang] -= run[end] - run[begin]
        return total / np.maximum([[len(t or "")] for t in texts] or np.zeros((0, 1)), 1), some

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The best language's index (-1: none) and its score."""
        if not self.langs:
            return np.full(len(texts), -1), np.zeros(len(texts))
        h, some = self.entropies(texts)
        z = np.exp(-(h - h.min(1, keepdims=True)) * self.temperature) if len(h) else h
        best = h.argmin(1) if len(h) else np.zeros(0, int)
        return np.where(some, best, -1), np.where(some, 1 / np.maximum(z.sum(1), 1), 0.0)


def publish(table: DataFrame) -> Model:
    """Write the arrays of a table of estimate() as two files to the shared folder; executors fetch them when they need them.

    The rows pass the driver one partition at a time; it holds none of them.
    """
    spark = table.sparkSession
    rows = work_table(packed(table), "packed")
    sizes = {(r.lang, r.part): r.n for r in rows.groupBy("lang", "part").agg(F.sum("n").alias("n")).collect()}  # nine a language
    langs = sorted({lang for lang, _ in sizes})
    if not langs:
        return Model([])
    jvm, tag, streams = spark.sparkContext._jvm, uuid.uuid4().hex, []
    for kind in ("keys", "values"):
        path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/lang-{tag}.{kind}")
        streams.append((path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)))
    unseen = {}
    for r in rows.orderBy("lang", "part", "first").toLocalIterator():
        if r.part == 2 * ORDER:
            unseen[r.lang] = float(np.frombuffer(r["values"], "<f4")[0])
        for (_, out), data in zip(streams, (r["keys"], r["values"]), strict=True):
            out.write(bytearray(data))
    for path, out in streams:
        out.close()
        spark.sparkContext.addFile(path.toString())
    parts, at = [], 0
    for lang in langs:
        begin = [at]
        for part in range(2 * ORDER + 1):
            at += sizes.get((lang, part), 0)
            begin.append(at)
        parts.append(begin)
    return Model(langs, tuple(f"lang-{tag}.{kind}" for kind in ("keys", "values")), parts, [unseen[x] for x in langs])


def fit_languages(documents: DataFrame, aside: float = ASIDE, calibration_rows: int = CALIBRATION_ROWS, wrongly_rejected: float = 0.01) -> Model:
    """Models of all languages from all rows that may be learned from, but for those set aside to calibrate them."""
    rows = learnable(documents)
    facts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum((F.col("place") < aside).cast("long")).alias("aside")).collect()  # one row a language
    small = [r.lang for r in facts if r.aside == r.n]
    spare = (F.col("place") < aside) & ~F.col("lang").isin(small)
    model = publish(estimate(work_table(count_grams(rows.where(~spare)), "grams")))
    over = sum(r.aside for r in facts if r.aside < r.n)
    if not over or not model.langs:
        return model
    sample = rows.where(spare & (F.length("text") > 0) & (F.col("place") < aside * min(1.0, calibration_rows / over))).select("lang", "text")
    spread = documents.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, some = spread.value.entropies(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(h), pa.list_(pa.float64())), pa.array(some)], ["lang", "h", "some"])

    got = sample.mapInArrow(measure, "lang string, h array<double>, some boolean").toPandas()
    got = got[got.lang.isin(model.langs) & got.some]
    h, truth = np.array(got.h.tolist()).reshape(-1, len(model.langs)), got.lang.map({x: i for i, x in enumerate(model.langs)}).to_numpy()
    if len(h):
        loss = []
        grid = [2.0**k for k in range(-2, 9)]
        for t in grid:
            z = -(h - h.min(1, keepdims=True)) * t
            loss.append(float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), truth])))
        model.temperature = grid[int(np.argmin(loss))]
        z = np.exp(-(h - h.min(1, keepdims=True)) * model.temperature)
        right = h.argmin(1) == truth
        model.least = float(np.quantile((1 / z.sum(1))[right], wrongly_rejected)) if right.any() else 0.0
    return model


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row."""
    spread = documents.sparkSession.sparkContext.broadcast(model)  # a few numbers a language; the arrays are files
    own = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = spread.value
        names = np.array([*m.langs, "und"], object)
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                best, score = m.scores(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(names[best], pa.string()), pa.array(score, pa.float64()), pa.array(score < m.least)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return own.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
