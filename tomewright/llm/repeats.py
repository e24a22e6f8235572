"""Exact repeated byte strings by enhanced suffix arrays.

A byte is removed if it is covered by a string of `length` bytes that also starts earlier: in a document with a
smaller id, or in the same document further left. The documents are dealt into blocks; no task needs all of them.

1. Anchors. In every window of `length` bytes the gram with the least hash is its anchor, the leftmost of equals.
   Equal windows have equal anchors at equal offsets. The windows of one anchor form a segment. Each block sends the
   distinct hashes of its anchors to their buckets, which tell each block the hashes that are found twice or more.
2. Segments. A block sends the segments of those hashes, equal ones once, the earliest of them, to the buckets. A
   hash of very many different segments (a line that is frequent everywhere) is sent as single windows, each as two
   independent 64-bit hashes of all its bytes and its place, so that it falls apart over the buckets; of equal windows
   the earliest, while the others of the block are known to be repeats and only their ranges are sent along. Windows
   of such hashes count as equal if all 128 bits are.
3. Suffix arrays. A bucket sorts the suffixes of the segments under a hash, computes common prefix lengths, and
   scans them with a stack: the nodes of the common-prefix interval tree of `length` or more whose occurrences
   differ in the byte to their left are the maximal repeats, each with all its occurrences. Every occurrence but the
   first is a range to remove.
4. Each block joins those ranges with what it repeats itself, and cuts.

Equal ids: their rows count as documents in order of a hash of their text (XXH64 as Spark takes it), then of the text;
equal rows are interchangeable. A null id counts as smaller than any. Null and empty texts have no bytes; texts
shorter than `length` keep all. An empty table gives none. Only doc_id and text are read, so other columns may have
any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import pieces, utf8

LENGTH, GRAM = 100, 50
#: Windows that are hashed in one go.
CHUNK = 1 << 17
#: Different segments with one hash beyond which its windows are sent one by one.
HOT = 20_000
#: Suffixes in one suffix array at most, if a hash has no more.
SUFFIXES = 50_000
NONE = np.zeros(0, np.int64)
U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
#: Two independent hashes: a base, and a number for each byte.
_bases = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F)
_bytes = tuple(_mix(np.arange(1 + 256 * k, 257 + 256 * k, dtype=np.uint64) * U(0x9E3779B97F4A7C15)) for k in (0, 1))


def _sums(data: np.ndarray, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the bytes times powers of the base, and the inverse powers: they give the hash of any stretch."""
    n = len(data)
    cap = max(n, CHUNK + 4 * LENGTH)
    if (cap, which) not in _powers:
        with np.errstate(over="ignore"):
            _powers[cap, which] = tuple(np.cumprod(np.concatenate([[U(1)], np.full(cap, U(b))])) for b in (_bases[which], pow(_bases[which], -1, 1 << 64)))
    up, down = _powers[cap, which]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_bytes[which][data] * up[:n], out=total[1:])
    return total, down


def gram_hashes(data: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A hash of data[i : i + size] for every i."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    total, down = _sums(data, which)
    return _mix((total[size:] - total[:-size]) * down[: len(data) - size + 1])


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of `width` keys."""
    have = 1
    while 2 * have <= width:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    return np.minimum(keys[: len(keys) - (width - have)], keys[width - have :]) if have < width else keys


def segments(offsets: np.ndarray, data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(row, start in the document, windows, hash of the anchor, its offset, hash of all bytes) of every segment."""
    sizes = np.diff(offsets)
    out = []
    for at in range(0, max(0, len(data) - length + 1), CHUNK):
        end = min(at + CHUNK, len(data) - length + 1)  # window starts of this chunk
        total, down = _sums(data[at : end + length - 1])
        h = _mix((total[gram:] - total[:-gram]) * down[: end - at + length - gram])
        place = np.arange(len(h), dtype=np.uint64)
        anchor = (_least((h & ~U((1 << 24) - 1)) | place, length - gram + 1) & U((1 << 24) - 1)).astype(np.int64)
        lo, hi = np.searchsorted(offsets, at, "right") - 1, np.searchsorted(offsets, end, "left")
        rows = np.arange(lo, hi)
        rows = rows[sizes[rows] >= length]
        first, last = np.maximum(offsets[rows], at) - at, np.minimum(offsets[rows + 1] - length + 1, end) - at
        ok = first < last
        rows, first, last = rows[ok], first[ok], last[ok]
        if not len(rows):
            continue
        delta = np.zeros(end - at + 1, np.int8)
        delta[first] += 1
        np.subtract.at(delta, last, 1)
        valid = np.cumsum(delta[:-1], dtype=np.int8) > 0
        new = np.empty(end - at, bool)
        new[0] = True
        np.not_equal(anchor[1:], anchor[:-1], out=new[1:])
        new[first] = True
        starts = np.flatnonzero(new & valid)
        row = rows[np.searchsorted(first, starts, "right") - 1]
        stop = np.minimum(np.append(starts[1:], end - at), last[np.searchsorted(first, starts, "right") - 1])
        whole = _mix((total[stop + length - 1] - total[starts]) * down[starts])
        out.append((row, starts + at - offsets[row], stop - starts, _mix(~h[anchor[starts]]), anchor[starts] - starts, whole))  # mixed anew: least hashes crowd near zero
    return tuple(np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.uint64 if k in (3, 5) else np.int64) for k in range(6))


# --- the enhanced suffix array -------------------------------------------------------------------------------------


def interval_tree(texts: list[bytes], length: int, starts: list[np.ndarray] | None = None) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """The maximal repeats of `length` bytes or more within and between texts: (bytes, [(text, start), ...]).

    starts: for each text the suffixes that may count; all, if None. A repeat is given with all its occurrences; one
    whose occurrences all follow the same byte isn't maximal and is left out. A text's begin differs from any byte.
    """
    if not texts:
        return
    lens = np.array([len(t) for t in texts])
    own = [np.arange(max(0, n - length + 1)) if starts is None else np.asarray(s) for n, s in zip(lens, starts or lens, strict=True)]
    text = np.repeat(np.arange(len(texts)), [len(o) for o in own])
    if len(text) < 2:
        return
    start = np.concatenate(own)
    width = int(lens.max())
    data = np.frombuffer(b"".join(texts) + bytes(width), np.uint8)
    base = np.cumsum(lens) - lens
    room = lens[text] - start
    suffix = base[text] + start
    head = np.lib.stride_tricks.sliding_window_view(data, length)[suffix]
    keys = np.ascontiguousarray(np.pad(head, ((0, 0), (0, -length % 8)))).view(">u8").astype(np.uint64)
    order = np.lexsort(keys.T[::-1])
    same = (keys[order[1:]] == keys[order[:-1]]).all(1)
    edge = np.flatnonzero(~same) + 1
    for lo, hi in zip(np.insert(edge, 0, 0), np.append(edge, len(order)), strict=True):
        if hi - lo < 2:
            continue
        group = order[lo:hi]  # all share `length` bytes: a subtree of the interval tree
        tails = [bytes(data[suffix[i] : suffix[i] + room[i]]) for i in group]
        rank = sorted(range(len(group)), key=tails.__getitem__)
        tails, group = [tails[i] for i in rank], [int(group[i]) for i in rank]
        common = [_common(a, b) for a, b in zip(tails, tails[1:], strict=False)]
        left = [int(data[suffix[i] - 1]) if start[i] else -1 - i for i in group]
        yield from _scan(common, left, length, [(int(text[i]), int(start[i])) for i in group])


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid)
    return lo


def _scan(common: list[int], left: list[int], length: int, places: list) -> Iterator[tuple[int, list]]:
    """Stack scan of a subtree. An entry: (common prefix, first suffix, the byte to the left of all, or None: several)."""
    stack: list[list] = []
    for i, depth in enumerate([*common, 0]):
        first, byte = i, left[i]
        while stack and stack[-1][0] > depth:
            size, at, seen = stack.pop()
            seen = seen if seen == byte else None
            if seen is None and size >= length:
                yield size, places[at : i + 1]
            first, byte = at, seen
        if stack and stack[-1][0] == depth:
            stack[-1][2] = stack[-1][2] if stack[-1][2] == byte else None
        elif depth:
            stack.append([depth, first, byte])


# --- the distributed plan ------------------------------------------------------------------------------------------


def _ordered(block: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Ids (null: the least), ties, offsets and bytes of a block in order of id, tie and text; the ids as given."""
    names = block.column("doc_id").combine_chunks()
    block = pa.table({"id": pc.fill_null(names.cast(pa.int64()), -(1 << 63)), "tie": block.column("tie"), "text": block.column("text"), "name": names}).combine_chunks()
    block = block.sort_by([("id", "ascending"), ("tie", "ascending"), ("text", "ascending")])
    return block.column("id").to_numpy(), block.column("tie").to_numpy(), *utf8(block.column("text")), block.column("name").combine_chunks()


def _bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> U(32)) * U(buckets)) >> U(32)


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema.types, strict=True)], schema=schema)


HASHES = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
FOUND = pa.schema([("block", pa.int64()), ("hashes", pa.binary()), ("hot", pa.binary())])
SENT = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary()), ("places", pa.binary()), ("bytes", pa.binary()), ("windows", pa.binary()), ("ranges", pa.binary())])
RANGES = pa.schema([("block", pa.int64()), ("ranges", pa.binary())])
PLACE = np.dtype([("doc", "<i8"), ("tie", "<i8"), ("row", "<i4"), ("start", "<i4"), ("size", "<i4"), ("anchor", "<i4")])
WINDOW = np.dtype([("one", "<u8"), ("two", "<u8"), ("doc", "<i8"), ("tie", "<i8"), ("row", "<i4"), ("start", "<i4")])
COUNT = np.dtype([("all", "u1"), ("kinds", "<i4")])
RANGE = np.dtype([("row", "<i4"), ("start", "<i4"), ("size", "<i4")])


def _send_hashes(length: int, gram: int, buckets: int):
    """Of each anchor hash of a block: how many segments it has, up to 255, and how many different ones."""

    def run(block: pa.Table) -> pa.Table:
        _, _, offsets, data, _ = _ordered(block)
        _, _, _, h, _, whole = segments(offsets, data, length, gram)
        order = np.lexsort((whole, h))
        h, whole = h[order], whole[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else NONE
        new = np.append(True, (h[1:] != h[:-1]) | (whole[1:] != whole[:-1])) if len(h) else np.zeros(0, bool)
        count = np.zeros(len(first), COUNT)
        count["all"] = np.minimum(np.diff(np.append(first, len(h))), 255)
        count["kinds"] = np.add.reduceat(new, first, dtype=np.int64) if len(first) else 0
        h = h[first]
        cut = np.searchsorted(_bucket_of(h, buckets), np.arange(buckets + 1, dtype=np.uint64))
        name = block.column("block")[0].as_py()
        return _rows(HASHES, [(b, name, h[s:e].tobytes(), count[s:e].tobytes()) for b, (s, e) in enumerate(zip(cut, cut[1:], strict=False)) if e > s])

    return run


def _find_twice(rows: pa.Table) -> pa.Table:
    blocks = rows.column("block").to_numpy()
    each = [np.frombuffer(x.as_py(), np.uint64) for x in rows.column("hashes")]
    counts = np.concatenate([np.frombuffer(x.as_py(), COUNT) for x in rows.column("counts")])
    h, owner = np.concatenate(each), np.repeat(np.arange(len(each)), [len(x) for x in each])
    _, back = np.unique(h, return_inverse=True)
    keep, hot = np.bincount(back, counts["all"])[back] > 1, np.bincount(back, counts["kinds"])[back] > HOT
    cuts = np.searchsorted(owner, np.arange(len(each) + 1))
    out = []
    for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if keep[s:e].any():
            out.append((int(blocks[k]), h[s:e][keep[s:e]].tobytes(), hot[s:e][keep[s:e]].tobytes()))
    return _rows(FOUND, out)


def _first_of_equals(data: np.ndarray, at: np.ndarray, size: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """For each string (of data, in order of position) whether it is the first of its equals here; whole: its hash."""
    order = np.lexsort((size, whole))
    same = (whole[order[1:]] == whole[order[:-1]]) & (size[order[1:]] == size[order[:-1]])
    first = np.ones(len(at), bool)
    lead = order[np.maximum.accumulate(np.where(np.append(True, ~same), np.arange(len(order)), 0))] if len(order) else order
    raw = memoryview(data)
    for i, k in zip(order[1:][same].tolist(), lead[1:][same].tolist(), strict=True):
        a, b, n = int(at[i]), int(at[k]), int(size[i])
        first[i] = raw[a : a + n] != raw[b : b + n]  # of a collision both are sent
    return first


def _first_of_hashes(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """For each window, in order of position, whether it is the first with its two hashes."""
    order = np.lexsort((two, one))
    first = np.ones(len(one), bool)
    first[order[1:]] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
    return first


def _local(offsets: np.ndarray, data: np.ndarray, length: int, gram: int, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, start, bytes, hash and anchor of the segments with these hashes, and whether each is the first of its equals."""
    row, start, windows, h, anchor, whole = segments(offsets, data, length, gram)
    at = np.searchsorted(hashes, h)
    keep = np.flatnonzero((at < len(hashes)) & (hashes[np.minimum(at, len(hashes) - 1)] == h)) if len(hashes) else NONE
    row, start, size, h, anchor, whole = (x[keep] for x in (row, start, windows + length - 1, h, anchor, whole))
    return row, start, size, h, anchor, _first_of_equals(data, offsets[row] + start, size, whole)


def _joined_windows(row: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Ranges of these windows, in order of row and start; those that follow each other are joined."""
    first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
    out = np.zeros(len(first), RANGE)
    if len(first):
        out["row"], out["start"], out["size"] = row[first], start[first], np.diff(np.append(first, len(row))) + length - 1
    return out


def _hot_windows(offsets: np.ndarray, data: np.ndarray, row: np.ndarray, start: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of these segments, n each: the first of equals (one, two, row, start filled), and the ranges of the others."""
    out = np.zeros(int(n.sum()), WINDOW)
    out["row"] = np.repeat(row, n)
    out["start"] = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(len(out))
    where = offsets[out["row"]] + out["start"]
    for lo in range(0, len(data), CHUNK):
        inside = np.flatnonzero((where >= lo) & (where < lo + CHUNK))
        if len(inside):
            for which, name in enumerate(("one", "two")):
                out[name][inside] = gram_hashes(data[lo : lo + CHUNK + length - 1], length, which)[where[inside] - lo]
    once = _first_of_hashes(out["one"], out["two"])
    return out[once], _joined_windows(out["row"][~once], out["start"][~once], length)


def _send_segments(length: int, gram: int, buckets: int):
    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        if not found.num_rows or not block.num_rows:
            return _rows(SENT, [])
        ids, ties, offsets, data, _ = _ordered(block)
        hashes = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in found.column("hashes")])
        hot = np.concatenate([np.frombuffer(x.as_py(), bool) for x in found.column("hot")])
        order = np.argsort(hashes, kind="stable")
        hashes, hot = hashes[order], hot[order]
        row, start, size, h, anchor, first = _local(offsets, data, length, gram, hashes)
        row, start, size, h, anchor = (x[first] for x in (row, start, size, h, anchor))
        many = hot[np.searchsorted(hashes, h)]
        windows, later = _hot_windows(offsets, data, row[many], start[many], size[many] - length + 1, length)
        windows["doc"], windows["tie"] = ids[windows["row"]], ties[windows["row"]]
        windows = windows[np.argsort(windows["one"], kind="stable")]
        order = np.flatnonzero(~many)
        order = order[np.argsort(h[order], kind="stable")]
        row, start, size, h, anchor = (x[order] for x in (row, start, size, h, anchor))
        place = np.zeros(len(row), PLACE)
        for name, x in (("doc", ids[row]), ("tie", ties[row]), ("row", row), ("start", start), ("size", size), ("anchor", anchor)):
            place[name] = x
        raw, where, sizes = memoryview(data), (offsets[row] + start).tolist(), size.tolist()
        every = np.arange(buckets + 1, dtype=np.uint64)
        cut, cut_windows = np.searchsorted(_bucket_of(h, buckets), every), np.searchsorted(_bucket_of(windows["one"], buckets), every)
        name, out = block.column("block")[0].as_py(), []
        for b, (s, e, ws, we) in enumerate(zip(cut, cut[1:], cut_windows, cut_windows[1:], strict=False)):
            if e > s or we > ws:
                out.append((b, name, h[s:e].tobytes(), place[s:e].tobytes(), b"".join([raw[where[i] : where[i] + sizes[i]] for i in range(s, e)]), windows[ws:we].tobytes(), b""))
        return _rows(SENT, [*out, (name % buckets, name, b"", b"", b"", b"", later.tobytes())] if len(later) else out)

    return run


def _later_windows(rows: pa.Table, length: int) -> Iterator[tuple[int, bytes]]:
    """(block, ranges) of the hot windows that aren't the earliest of their equals in this bucket."""
    each = [np.frombuffer(x.as_py(), WINDOW) for x in rows.column("windows")]
    w, owner = np.concatenate(each), np.repeat(rows.column("block").to_numpy(), [len(x) for x in each])
    order = np.lexsort((w["start"], w["row"], w["tie"], w["doc"], w["two"], w["one"]))
    once = np.zeros(len(w), bool)
    once[order] = _first_of_hashes(w["one"][order], w["two"][order]) if len(w) else False
    w, owner = w[~once], owner[~once]
    order = np.lexsort((w["start"], w["row"], owner))
    w, owner = w[order], owner[order]
    for block in np.unique(owner):
        own = w[owner == block]
        yield int(block), _joined_windows(own["row"], own["start"], length).tobytes()


def _find_ranges(length: int, gram: int):
    def run(rows: pa.Table) -> pa.Table:
        blocks = rows.column("block").to_numpy()
        h = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in rows.column("hashes")])
        each = [np.frombuffer(x.as_py(), PLACE) for x in rows.column("places")]
        place, owner = np.concatenate(each), np.repeat(np.arange(len(each)), [len(x) for x in each])
        raw = b"".join(x.as_py() for x in rows.column("bytes"))
        begin = np.cumsum(place["size"]) - place["size"]
        order = np.lexsort((place["start"], place["row"], place["tie"], place["doc"], h))  # under each hash the earliest first
        ends = np.append(np.flatnonzero(np.diff(h[order])) + 1, len(h)) if len(h) else NONE
        gone: dict[int, list[list[int]]] = {}  # segment to ranges in it
        pool: list[int] = []
        waiting = 0

        def sort_group(flat: list[int], only: int | None = None) -> None:
            """only: the suffixes whose anchor stands at that offset; no others share `length` bytes with them."""
            texts = [raw[begin[i] : begin[i] + place["size"][i]] for i in flat]
            starts = None
            if only is not None:
                first = place["anchor"][flat] - only
                ok = (first >= 0) & (first <= place["size"][flat] - length)
                starts = [f[o] for f, o in zip(first[:, None], ok[:, None], strict=True)]
            own = list(zip(*(place[x][flat].tolist() for x in ("doc", "tie", "row", "start")), strict=True))
            longest: dict[tuple[int, int], int] = {}
            for size, where in interval_tree(texts, length, starts):
                keys = [(*own[t][:3], own[t][3] + s) for t, s in where]
                least = keys.index(min(keys))
                for k, w in enumerate(where):
                    if k != least and longest.get(w, 0) < size:  # of nested repeats at a place the longest says all
                        longest[w] = size
            for (t, s), size in sorted(longest.items()):
                note(flat[t], s, s + size)

        def note(i: int, start: int, end: int) -> None:
            """Ranges of a segment are joined as they come, so that few are held."""
            last = gone.setdefault(i, [[start, end]])[-1]
            if start <= last[1] and end >= last[0]:
                last[0], last[1] = min(start, last[0]), max(end, last[1])
            else:
                gone[i].append([start, end])

        at = 0
        for end in ends.tolist():
            group, at = order[at:end].tolist(), end
            if len(group) < 2:  # windows of one segment differ: their anchors stand at different offsets
                continue
            seen: dict[bytes, int] = {}
            for i in group:
                text = raw[begin[i] : begin[i] + place["size"][i]]
                if text in seen:  # an interval of equal strings; the earliest stands first
                    note(i, 0, len(text))
                else:
                    seen[text] = i
            suffixes = sum(len(t) - length + 1 for t in seen)
            if len(seen) > 1 and suffixes >= SUFFIXES:
                for only in range(length - gram + 1):
                    sort_group(list(seen.values()), only)
            elif len(seen) > 1:
                if waiting + suffixes > SUFFIXES:
                    sort_group(pool)
                    pool, waiting = [], 0
                pool += seen.values()
                waiting += suffixes
        sort_group(pool)
        cut = np.array([(i, s, e - s) for i, ranges in gone.items() for s, e in ranges], np.int64).reshape(-1, 3)
        out = np.zeros(len(cut), RANGE)
        if len(cut):
            out["row"], out["start"], out["size"] = place["row"][cut[:, 0]], place["start"][cut[:, 0]] + cut[:, 1], cut[:, 2]
        by = owner[cut[:, 0]] if len(cut) else NONE
        sent = [(int(b), x.as_py()) for b, x in zip(blocks, rows.column("ranges"), strict=True) if len(x.as_py())]
        return _rows(RANGES, [*sent, *_later_windows(rows, length), *((int(blocks[k]), out[by == k].tobytes()) for k in np.unique(by))])

    return run


def _cut(length: int, gram: int):
    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        _, _, offsets, data, names = _ordered(block)
        cover = np.zeros(len(data) + 1, np.int32)
        h, count = np.unique(segments(offsets, data, length, gram)[3], return_counts=True)
        row, start, size, _, _, first = _local(offsets, data, length, gram, h[count > 1])
        ranges = [np.frombuffer(x.as_py(), RANGE) for x in found.column("ranges")]
        row, start, size = row[~first], start[~first], size[~first]
        if ranges:
            r = np.concatenate(ranges)
            row, start, size = np.append(row, r["row"]), np.append(start, r["start"]), np.append(size, r["size"])
        at = offsets[row] + start
        np.add.at(cover, at, 1)
        np.subtract.at(cover, at + size, 1)
        gone = np.cumsum(cover[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[offsets[1:]] - total[offsets[:-1]]
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        inner = offsets[:-1][np.diff(offsets) > 0]
        opens[inner] = gone[inner]
        total = np.concatenate([[0], np.cumsum(opens)])
        spans = total[offsets[1:]] - total[offsets[:-1]]
        kept = []
        for s, e, n in zip(offsets[:-1].tolist(), offsets[1:].tolist(), removed.tolist(), strict=True):
            kept.append((data[s:e][~gone[s:e]] if n else data[s:e]).tobytes())
        return pa.table({"doc_id": names, "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(removed), "n_spans": pa.array(spans), "kept": pa.array(kept, pa.binary())})

    return run


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if pa.types.is_binary(f.type) else 'long'}" for f in schema)


def cut_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, block_bytes: int = 2 << 20) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; kept: the remaining bytes."""
    if not 1 <= gram <= length:
        raise ValueError("a gram must fit into the length")
    blocks = pieces(documents, block_bytes, 2)
    buckets = blocks
    kind = documents.schema["doc_id"].dataType.simpleString()
    docs = documents.select(F.expr(f"pmod(xxhash64(doc_id, text), {blocks}L)").alias("block"), "doc_id", F.xxhash64("text").alias("tie"), "text")
    hashes = docs.groupBy("block").applyInArrow(_send_hashes(length, gram, buckets), _ddl(HASHES))
    twice = hashes.groupBy("bucket").applyInArrow(_find_twice, _ddl(FOUND))
    sent = docs.groupBy("block").cogroup(twice.groupBy("block")).applyInArrow(_send_segments(length, gram, buckets), _ddl(SENT))
    ranges = sent.groupBy("bucket").applyInArrow(_find_ranges(length, gram), _ddl(RANGES))
    return docs.groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(_cut(length, gram), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def digest_of(kept) -> "F.Column":
    return F.sha2(kept, 256)


def brute_force(texts: list[bytes], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """The same for texts in order of their ids, from the definition."""
    seen: set[bytes] = set()
    out = []
    for t in texts:
        gone = [False] * len(t)
        for s in range(len(t) - length + 1):
            w = t[s : s + length]
            if w in seen:
                gone[s : s + length] = [True] * length
            seen.add(w)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone], strict=False))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out
