"""URL filters by a sorted digest array.

The rules (a host with all its subdomains, and a path prefix) become one file: 64-bit xxhash keys in order, the
rule strings and their verdicts. Executors memory-map it. Each url gives the few strings that could be a rule for
it (every host suffix with every path length the list knows); their digests are looked up in one vectorised binary
search, and each hit is confirmed against the stored string, so that a collision never decides.

Null urls and urls without `://` have an empty host and path; no rule fits them. Of several rules that fit, the
longest string wins, then the one with the longer host. Of repeated rules the verdict that is last by code point holds. A
list without rules gives every url the default verdict. Null and repeated ids keep their own rows; very long urls are
judged whole; an empty table gives none. Only the id and url columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomewright.llm.common import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of an index file that every executor may be sent; a longer list is joined instead.
INDEX_BYTES = 512 << 20


def digest(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text)


def build_index(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """One file from (host, path, verdict): counts, digests in order, string offsets, path lengths, verdicts, strings."""
    own: dict[bytes, tuple[int, str]] = {}
    for h, p, v in sorted(rules, key=lambda r: r[2]):
        own[(h.translate(str.maketrans(UPPER, LOWER)) + p).encode()] = (len(h.encode()), v)
    rows = sorted((digest(k), k, h, v) for k, (h, v) in own.items())
    verdicts = sorted({v for *_, v in rows})
    blob, names = b"".join(k for _, k, _, _ in rows), "\n".join(verdicts).encode()
    lengths = sorted({len(k) - h for _, k, h, _ in rows})
    parts = [
        np.array([len(rows), len(lengths), len(names)], np.uint64),
        np.array([d for d, *_ in rows], np.uint64),
        np.cumsum([0, *(len(k) for _, k, _, _ in rows)]).astype(np.uint64),
        np.array(lengths, np.uint64),
        np.array([verdicts.index(v) for *_, v in rows], np.uint64),
    ]
    return b"".join(x.tobytes() for x in parts) + names + blob


class DigestIndex:
    """A memory-mapped index file."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n, k, m = (int(x) for x in raw[:24].view(np.uint64))
        at = 24
        self.lengths: list[int] = []
        for name, count in (("digests", n), ("offsets", n + 1), ("lengths", k), ("codes", n)):
            setattr(self, name, raw[at : at + 8 * count].view(np.uint64))
            at += 8 * count
        self.lengths = [int(x) for x in self.lengths]
        self.verdicts = bytes(raw[at : at + m]).decode().split("\n")
        self.strings = raw[at + m :]

    def probe(self, texts: list[bytes]) -> np.ndarray:
        """The position of each text among the rules, or -1."""
        found = np.full(len(texts), -1)
        if not texts or not len(self.digests):
            return found
        keys = np.fromiter(map(digest, texts), np.uint64, len(texts))
        lo = np.searchsorted(self.digests, keys)
        todo = np.flatnonzero((lo < len(self.digests)) & (self.digests[np.minimum(lo, len(self.digests) - 1)] == keys))
        for i in todo:  # few: digests that are equal; the strings decide
            k = int(lo[i])
            while k < len(self.digests) and self.digests[k] == keys[i] and found[i] < 0:
                if bytes(self.strings[int(self.offsets[k]) : int(self.offsets[k + 1])]) == texts[i]:
                    found[i] = k
                k += 1
        return found

    def judge(self, hosts: list[str], paths: list[str], default: str) -> tuple[list[str | None], list[str]]:
        texts, owner, rank = [], [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            h, p = host.encode(), path.encode()
            ends = [n for n in self.lengths if n <= len(p)]
            at = 0
            while h and at >= 0:
                suffix = h[at:]
                for n in ends:
                    texts.append(suffix + p[:n])
                    owner.append(i)
                    rank.append((len(suffix) + n, len(suffix)))
                at = h.find(b".", at) + 1 or -1
        best: dict[int, tuple] = {}
        for i, k in enumerate(self.probe(texts)):
            if k >= 0:
                best[owner[i]] = max(best.get(owner[i], ((-1, -1), -1, b"")), (rank[i], int(k), texts[i]))
        rules = [best[i][2].decode() if i in best else None for i in range(len(hosts))]
        return rules, [self.verdicts[int(self.codes[best[i][1]])] if i in best else default for i in range(len(hosts))]


def host_and_path(url) -> tuple["F.Column", "F.Column"]:
    """Host (A-Z lower-cased) and path of a url column; both empty where there is no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    part = lambda k: F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def _publish(spark: SparkSession, data: bytes) -> str:
    """Put the file into the shared folder by Spark's file system, and have each executor fetch it once."""
    name = f"url-{hashlib.sha256(data).hexdigest()[:24]}.digests"
    path = f"{shared_dir(spark)}/{name}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        out = fs.create(target, True)
        for at in range(0, len(data), 1 << 22):
            out.write(bytearray(data[at : at + (1 << 22)]))
        out.close()
    spark.sparkContext.addFile(path)
    return name


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = "allow", id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of every row of pages; rules are (host, path, verdict).

    An index of over INDEX_BYTES isn't sent out: the rules are joined instead, with the same result.
    """
    rules = list(rules)
    data = build_index(rules)
    if len(data) > INDEX_BYTES:
        return filter_urls_joined(pages, pages.sparkSession.createDataFrame(rules, "host string, path string, verdict string"), default, id_column, url_column)
    name = _publish(pages.sparkSession, data)
    host, path = host_and_path(F.col(url_column))
    own = pages.select(F.col(id_column), host.alias("host"), path.alias("path"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestIndex(SparkFiles.get(name))
        for b in batches:
            got, verdicts = index.judge(b.column(1).to_pylist(), b.column(2).to_pylist(), default)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.string()), pa.array(verdicts, pa.string())], [id_column, "host", "path", "rule", "verdict"])

    kind = own.schema[id_column].dataType.simpleString()
    return own.mapInArrow(judge, f"`{id_column}` {kind}, host string, path string, rule string, verdict string")


def filter_urls_joined(pages: DataFrame, rules: DataFrame, default: str = "allow", id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """The same for a rule table (host, path, verdict) of any size: candidate strings are joined by shuffle, not sent out.

    Urls are brought to one for each host and path, judged, and joined back to their rows; those without a host, which no
    rule fits, take no part in the join. What is sent to all tasks is the list of lengths that rule paths have.
    """
    host, path = host_and_path(F.col(url_column))
    own = pages.select(F.col(id_column), host.alias("host"), path.alias("path"))
    keyed = rules.select(F.concat(F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit(""))).alias("rule"), F.coalesce(F.length("path"), F.lit(0)).alias("cut"), "verdict").where("rule is not null")
    cuts = keyed.groupBy().agg(F.collect_set("cut").alias("cuts"))  # one row: as many lengths as paths have
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    urls = own.distinct().where("host <> ''").join(F.broadcast(cuts))
    cand = urls.select("host", "path", F.explode(tails).alias("tail"), "cuts").select("host", "path", "tail", F.explode("cuts").alias("cut")).where("cut <= length(path)")
    cand = cand.select("host", "path", F.length("tail").alias("h"), F.concat("tail", F.expr("left(path, cut)")).alias("rule")).distinct()
    best = cand.join(keyed.groupBy("rule").agg(F.max("verdict").alias("verdict")), "rule").groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "h")).alias("b"))
    judged = own.where("host <> ''").join(best, ["host", "path"], "left").select(*own.columns, "b")
    rest = own.where("host = ''").withColumn("b", F.lit(None).cast(best.schema["b"].dataType))
    return judged.unionByName(rest).select(id_column, "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.verdict", F.lit(default)).alias("verdict"))
