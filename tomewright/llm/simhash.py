"""SimHash near-duplicates by bit-sliced comparison.

A text's word shingles (A-Z lower-cased, repeats included) are hashed with XXH64; a bit of its fingerprint is 1 if it
is set in over half the hashes. Fingerprints that differ in at most `radius` bits link, and documents of linked
fingerprints form groups.

Equal fingerprints are first brought to one row. The 64 bits are cut into radius + 2 blocks; two fingerprints within
the radius agree in at least two of them, so that every pair of blocks gives a key under which all linked pairs
meet. Fingerprints under a key that has too many are keyed anew, by all but `radius` of 8 blocks, then of 16: finer
keys under which their linked pairs meet as well, and of the last at most 2^(4 radius) fingerprints share one. So groups
become small without losing a link, and no row is ever compared with all others. In a group, bit planes are stored vertically: one word holds a bit of 64 fingerprints, and carry-save counters add up 64
distances at a time; a block of lanes is abandoned once all its distances exceed the radius. A group gives a
spanning star for each component in it, not its pairs.

Null and empty texts have the fingerprint zero and link like others; a text of fewer words than a shingle is one
shingle. Repeated rows keep their own rows. A null id never names a group; a group of null ids alone has the
component null, though its rows link like others. Only doc_id and text are read, so other columns may have any name.
An empty table gives no rows; a very long text is one row like others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import released, row_hash, without_rows, work_table
from tomewright.llm.graph import connected_components

SEED = 42
#: Fingerprints under one key above which they are keyed anew.
GROUP_ROWS = 4096
#: Rows that are compared in one go; a group is never divided.
CHUNK_ROWS = 1 << 16
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes, size: int) -> list[int]:
    words = text.lower().split()  # bytes: A-Z only, and the six ASCII spaces only
    if len(words) < size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    return [h(joined[s:e], SEED) for s, e in zip(starts, ends[size - 1 :], strict=False)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A fingerprint for each run of `counts` hashes; none: zero. Eight counters share a word."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    starts = (np.cumsum(counts) - counts)[full]
    cut = -(-counts[full] // 255)  # pieces of 255 at most: an eight-bit counter can't run over
    owner = np.repeat(np.arange(len(full)), cut)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(cut) - cut, cut)
    at = starts[owner] + 255 * nth
    first = np.cumsum(cut) - cut
    mask = np.uint64(0x0101010101010101)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & mask, at).view(np.uint8).reshape(-1, 8).astype(np.int64)
        ones = 2 * np.add.reduceat(lanes, first, axis=0) > counts[full][:, None]
        for byte in range(8):
            out[full] |= ones[:, byte].astype(np.uint64) << np.uint64(8 * byte + k)
    return out


def with_fingerprints(documents: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, rid, fp): the fingerprint of every row as a signed long; rid tells rows of one id apart."""
    own = documents.select("doc_id", "text", row_hash().alias("rid"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                rows = [shingle_hashes((x.as_py() or "").encode(), shingle) for x in part.column(1)]
                counts = np.fromiter(map(len, rows), np.int64, len(rows))
                flat = np.fromiter((h for r in rows for h in r), np.uint64, int(counts.sum()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(majority(flat, counts).view(np.int64))], ["doc_id", "rid", "fp"])

    return own.mapInArrow(lambda batches: released(run(batches)), f"doc_id {kind}, rid long, fp long")


def key_masks(level: int, radius: int) -> list[int]:
    """Masks of which one at least covers only bits in which two fingerprints within the radius agree.

    Level 0: two of radius + 2 blocks; 1: all but `radius` of 8 blocks; 2: all but `radius` of 16 blocks.
    """
    parts = (radius + 2, 8, 16)[level]
    keep = (2, parts - radius, parts - radius)[level]
    blocks = [sum(1 << i for i in range(64 * k // parts, 64 * (k + 1) // parts)) for k in range(parts)]
    return [sum(c) for c in combinations(blocks, keep)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _planes(fp: np.ndarray) -> np.ndarray:
    """64 rows of words: bit i % 64 of word i // 64 in row p is bit p of fingerprint i; two spare words follow."""
    words = -(-len(fp) // 64)
    bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    out = np.zeros((64, words * 8), np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    out[:, : packed.shape[1]] = packed
    return np.pad(out.view(np.uint64), ((0, 0), (0, 2)))


def near_roots(fp: np.ndarray, left: np.ndarray, radius: int) -> np.ndarray:
    """For each row a row of its component (within its group); left: how many rows of its group follow.

    Row i is compared with row i + s for s = 1, 2, ...: 64 distances in each word.
    """
    planes, root, bits = _planes(fp), np.arange(len(fp)), radius.bit_length()
    lanes_of = lambda on: np.pad(np.packbits(on, bitorder="little"), (0, -(-(-len(on) // 8)) % 8)).view(np.uint64)
    for s in range(1, int(left.max(initial=0)) + 1):
        mask = lanes_of(left >= s)
        at = np.flatnonzero(mask)
        over = ~mask[at]
        count = [np.zeros(len(at), np.uint64) for _ in range(bits)]
        q, r = divmod(s, 64)
        for p in range(64):
            low, row = planes[p, np.minimum(at + q, planes.shape[1] - 1)], planes[p]
            if r:
                low = (low >> np.uint64(r)) | (row[np.minimum(at + q + 1, planes.shape[1] - 1)] << np.uint64(64 - r))
            carry = row[at] ^ low
            for c in range(bits):
                carry, count[c] = count[c] & carry, count[c] ^ carry
            over |= carry
            if p % 4 == 3:
                live = over != FULL
                if not live.all():
                    at, over, count = at[live], over[live], [c[live] for c in count]
                    if not len(at):
                        break
        if not len(at):
            continue
        lanes = np.unpackbits(over.view(np.uint8), bitorder="little").reshape(-1, 64) == 0
        w, k = np.nonzero(lanes)
        i = 64 * at[w] + k
        if radius + 1 != 1 << bits:  # the counters hold more than the radius: look at the sums
            i = i[np.bitwise_count(fp[i] ^ fp[i + s]) <= radius]
        while len(i := i[root[i] != root[i + s]]):
            low, high = np.minimum(root[i], root[i + s]), np.maximum(root[i], root[i + s])
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
    return root


def _stars(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros((0, 4), np.int64)]

        def compare(rows: np.ndarray) -> pa.RecordBatch:
            edge = np.flatnonzero((np.diff(rows[:, :2], axis=0) != 0).any(1)) + 1
            ends = np.append(edge, len(rows))
            left = np.repeat(ends, np.diff(np.insert(ends, 0, 0))) - np.arange(len(rows)) - 1
            some = np.flatnonzero((left > 0) | np.append(False, left[:-1] > 0))
            rows, left = rows[some], left[some]
            root = near_roots(np.ascontiguousarray(rows[:, 2]).view(np.uint64), left, radius)
            i = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(rows[root[i], 3]), pa.array(rows[i, 3])], ["a", "b"])

        for b in batches:
            held.append(np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]))
            if sum(map(len, held)) >= CHUNK_ROWS:
                rows = np.concatenate(held)
                last = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(1))
                cut = int(last[-1]) + 1 if len(last) else 0
                held = [rows[cut:]]
                if cut:
                    yield compare(rows[:cut])
        if len(rows := np.concatenate(held)):
            yield compare(rows)

    return run


def near_edges(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """Star edges (a, b) between the nodes (node, fp; fp distinct) whose fingerprints are within the radius, by group."""
    rows, out = nodes.select("node", "fp"), None
    for level in range(3):
        masks = F.array(*[F.lit(_signed(m)) for m in key_masks(level, radius)])
        keyed = rows.withColumn("mask", F.explode(masks)).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp", "node")
        hot = work_table(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > GROUP_ROWS).select("mask", "key"), "hot") if level < 2 else None
        last = hot is None or hot.isEmpty()
        cold = keyed if last else keyed.join(hot, ["mask", "key"], "left_anti")
        edges = cold.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(_stars(radius), "a long, b long")
        out = edges if out is None else out.union(edges)
        if last:
            break
        rows = work_table(keyed.join(hot, ["mask", "key"], "left_semi").select("node", "fp").distinct(), "hot-rows")
    return out


def near_duplicates(documents: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, rid, fp, component, component_id) of every row.

    component_id: the smallest doc_id that can be reached over links, its own included; component: the least
    fingerprint of the group, which differs between groups that share an id.
    """
    prints = work_table(with_fingerprints(documents, shingle), "fingerprints")
    nodes = work_table(prints.groupBy("fp").agg(F.min("doc_id").cast("long").alias("least")), "nodes")
    groups = connected_components(near_edges(nodes.select(F.col("fp").alias("node"), "fp"), radius))
    roots = nodes.join(groups, nodes.fp == groups.id, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    names = roots.groupBy("component").agg(F.min("least").alias("component_id"))
    return prints.join(roots.join(names, "component"), "fp").select("doc_id", "rid", "fp", "component", "component_id")


def one_of_each(documents: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """Of each group the row with the smallest id, once, with all its columns; rows with a null id all stay.

    Of several texts of a group with that id the one with the least hash stays; of equal rows any.
    """
    found = work_table(near_duplicates(documents, shingle, radius).where("doc_id is not null"), "groups")
    first = found.where("doc_id = component_id").groupBy("component", "doc_id").agg(F.min("rid").alias("rid"), F.count("*").alias("n"))
    first = work_table(first, "first")
    gone = found.join(first.select("component", F.col("rid").alias("first")), "component").where("doc_id <> component_id or rid <> first")
    kept = without_rows(documents, gone)
    again = first.where("n > 1")  # ids that several rows of a group have
    if again.isEmpty():
        return kept
    once = kept.join(again.select("doc_id"), "doc_id", "left_semi").select(*[F.col(f"`{c}`") for c in documents.columns]).dropDuplicates(["doc_id", "text"])
    return kept.join(again.select("doc_id"), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns]).unionByName(once)


def hex_fingerprint(fp) -> "F.Column":
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
