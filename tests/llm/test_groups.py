"""Operators that compare rows: mixing, repeats, SimHash, decontamination; and the pipeline."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tomewright.llm import decontaminate, mixing, repeats, simhash
from tomewright.llm.graph import connected_components

SPACE = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(SPACE, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


# --- mixing ----------------------------------------------------------------------------------------------------------


def plain_targets(size):
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    w = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(size.values()))
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * size[s] or size[s] == 0}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * size[s]
            left -= target[s]
        open_ -= over
    return target


def test_mixing_targets_and_copies(docs, rows):
    got = {r.doc_id: r for r in mixing.sampled(docs).collect()}
    size, own = defaultdict(int), {}
    for i, text, _, source, *_ in rows:
        own[i] = len(re.findall(SPACE, text or ""))
        size[source] += own[i]
    target = plain_targets(dict(size))
    taken, copies = defaultdict(int), defaultdict(list)
    for i, text, _, source, *_ in rows:
        r = got[i]
        assert r.size == own[i] and r.source_size == size[source] and abs(r.target - target[source]) < 1e-6
        taken[source] += r.copies * r.size
        copies[source].append(r.copies)
        assert 0 <= r.copies <= 3
    for s in size:
        rate = target[s] / size[s]
        assert set(copies[s]) <= {int(np.floor(rate)), int(np.ceil(rate))}
        assert abs(sum(copies[s]) - rate * len(copies[s])) < 1
        assert abs(taken[s] - target[s]) <= max(own[i] for i, _, _, x, *_ in rows if x == s)


def test_mixing_repeats_itself_and_emits_copies(docs, odd, none):
    key = lambda df: sorted(map(str, df.collect()))
    assert key(mixing.sampled(docs)) == key(mixing.sampled(docs.repartition(7)))
    total = mixing.sampled(odd).agg(F.sum("copies")).first()[0]
    mixed = mixing.mix(odd)
    assert mixed.count() == total and mixed.columns == odd.columns
    assert mixing.mix(none).count() == 0


def test_mixing_emits_what_systematic_sampling_crosses(docs, rows):
    """Along the order of size bins, buckets and hashes each source's copies are the steps of floor(n * rate + offset)."""
    got = mixing._sampled(docs, mixing.WEIGHTS, mixing.MOST, mixing.SEED, ("doc_id", "source")).select("kept.*", "copies", "size", "target", "source_size")
    by = defaultdict(list)
    for r in got.collect():
        by[r.keep_1].append(r)
    for own in by.values():
        own.sort(key=lambda r: int(np.floor(np.log2(r.size + 1) * 64)))
        rate = own[0].target / own[0].source_size
        sums = np.cumsum([r.copies for r in own])
        assert all(abs(s - (k + 1) * rate) < 1 + 1e-9 for k, s in enumerate(sums) if k + 1 == len(own) or own[k].size != own[k + 1].size)


def test_mixing_keeps_columns_of_any_name(spark):
    names = "doc_id long, text string, source string, size string, copies string, target string, source_size string, kept string, `a.b` string, rate int"
    df = spark.createDataFrame([(i, "w " * i, "s", "a", "b", "c", "d", "e", "f", 1) for i in range(9)], names)
    out = mixing.mix(df)
    assert out.columns == df.columns and {tuple(r)[3:] for r in out.collect()} == {("a", "b", "c", "d", "e", "f", 1)}


def test_targets_with_tight_caps(spark):
    size = {"a": 1000, "b": 10, "c": 5, "d": 0, None: 700, "é": 3}
    df = spark.createDataFrame(list(size.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    expected = plain_targets(size)
    assert all(abs(got[s] - expected[s]) < 1e-6 for s in size)


# --- repeats ---------------------------------------------------------------------------------------------------------


def check_repeats(df, pairs, **how):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in repeats.cut_repeats(df, **how).withColumn("sha", repeats.digest_of("kept")).collect()}
    pairs = sorted(pairs)
    expected = repeats.brute_force([(t or "").encode() for _, t in pairs], how.get("length", 100))
    assert got == {i: e for (i, _), e in zip(pairs, expected, strict=True)}


def test_repeats_equal_definition(docs, rows):
    check_repeats(docs, [(r[0], r[1]) for r in rows])


def test_repeats_with_short_windows_and_small_blocks(spark, monkeypatch):
    rng = random.Random(3)
    pairs = [(i, "".join(rng.choice("abé") for _ in range(rng.randint(0, 80)))) for i in range(60)]
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    monkeypatch.setattr(repeats, "CHUNK", 64)
    check_repeats(df, pairs, length=12, gram=6, block_bytes=200)
    check_repeats(df, pairs, length=9, gram=9)


def test_hot_hashes_fall_apart(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    line = word(70)
    pairs = [(i, word(60) + line + word(60)) for i in range(40)] + [(100 + i, "x" * 5 + line * 2) for i in range(4)]
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    check_repeats(df, pairs)
    blocks = [repeats.pa.table({"block": [k] * 22, "tie": [0] * 22, "doc_id": [p[0] for p in pairs[22 * k : 22 * k + 22]], "text": [p[1] for p in pairs[22 * k : 22 * k + 22]]}) for k in (0, 1)]
    for hot, most in ((5, 50_000), (10**6, 30)):
        monkeypatch.setattr(repeats, "HOT", hot)
        monkeypatch.setattr(repeats, "SUFFIXES", most)
        sent = [repeats._send_hashes(100, 50, 1)(b) for b in blocks]
        found = repeats._find_twice(repeats.pa.concat_tables(sent))
        mine = lambda t, k: t.filter(repeats.pc.equal(t.column("block"), k))
        segs = repeats.pa.concat_tables([repeats._send_segments(100, 50, 1)(b, mine(found, k)) for k, b in enumerate(blocks)])
        ranges = repeats._find_ranges(100, 50)(segs)
        out = [repeats._cut(100, 50)(b, mine(ranges, k)) for k, b in enumerate(blocks)]
        removed = {i: n for t in out for i, n in zip(t.column("doc_id").to_pylist(), t.column("n_removed").to_pylist(), strict=True)}
        expected = repeats.brute_force([t.encode() for _, t in pairs])
        assert removed == {i: e[1] for (i, _), e in zip(pairs, expected, strict=True)}


def test_hot_windows_repeated_within_a_block_go(spark, monkeypatch):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    line, other = word(130), word(260)
    pairs = [(i, word(60) + line + word(60)) for i in range(12)] + [(20 + i, word(40) + other[i : 200 + i] + word(9) + line + line) for i in range(6)]
    monkeypatch.setattr(repeats, "HOT", 3)
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(2)
    blocks = [repeats.pa.table({"block": [k] * 9, "tie": [0] * 9, "doc_id": [p[0] for p in pairs[k::2]], "text": [p[1] for p in pairs[k::2]]}) for k in (0, 1)]
    found = repeats._find_twice(repeats.pa.concat_tables([repeats._send_hashes(100, 50, 1)(b) for b in blocks]))
    assert any(any(x.as_py()) for x in found.column("hot"))
    mine = lambda t, k: t.filter(repeats.pc.equal(t.column("block"), k))
    ranges = repeats._find_ranges(100, 50)(repeats.pa.concat_tables([repeats._send_segments(100, 50, 1)(b, mine(found, k)) for k, b in enumerate(blocks)]))
    out = [r for k, b in enumerate(blocks) for r in repeats._cut(100, 50)(b, mine(ranges, k)).to_pylist()]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], repeats.hashlib.sha256(r["kept"]).hexdigest()) for r in out}
    expected = repeats.brute_force([t.encode() for _, t in pairs])
    assert got == {i: e for (i, _), e in zip(pairs, expected, strict=True)}
    check_repeats(df, pairs)


def test_repeats_of_odd_rows(spark, odd, none):
    """Null ids count as the least; equal ids stand in order of the hash of their text; equal rows in any."""
    long = spark.createDataFrame([(5, "p q " * 90), (None, "p q " * 90), (None, "r s " * 60), (3, "r s " * 60), (5, "t u " * 70), (5, "t u " * 70)], "doc_id long, text string")
    for df in (odd.select("doc_id", "text"), long, long.union(odd.select("doc_id", "text"))):
        rows = df.select("doc_id", "text", F.xxhash64("text").alias("tie")).collect()
        rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.tie, r.text or ""))
        expected = repeats.brute_force([(r.text or "").encode() for r in rows])
        got = repeats.cut_repeats(df).withColumn("sha", repeats.digest_of("kept")).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in got) == Counter((r.doc_id, *e) for r, e in zip(rows, expected, strict=True))
    assert repeats.cut_repeats(none).count() == 0


def test_a_line_in_every_document_and_one_long_text(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line = word(140)
    pairs = [(i, f"{word(rng.randint(0, 90))}{line}{word(rng.randint(0, 90))}") for i in range(150)] + [(200, word(30_000) + line), (201, "z" * 20_000)]
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    for hot in (10, 20_000):
        monkeypatch.setattr(repeats, "HOT", hot)
        check_repeats(df, pairs, block_bytes=4000)


def test_interval_tree_gives_maximal_repeats_with_all_occurrences():
    rng = random.Random(1)
    for _ in range(30):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 25))) for _ in range(4)]
        got = {(texts[w[0][0]][w[0][1] : w[0][1] + n], tuple(sorted(w))) for n, w in repeats.interval_tree(texts, 3)}
        places = defaultdict(set)
        for i, t in enumerate(texts):
            for s in range(len(t)):
                for e in range(s + 3, len(t) + 1):
                    places[t[s:e]].add((i, s))
        expected = set()
        for x, at in places.items():
            left = {texts[i][s - 1] if s else (i, "begin") for i, s in at}
            right = {texts[i][s + len(x)] if s + len(x) < len(texts[i]) else (i, "end") for i, s in at}
            if len(at) > 1 and len(left) > 1 and len(right) > 1:
                expected.add((x, tuple(sorted(at))))
        assert got == expected


# --- simhash ---------------------------------------------------------------------------------------------------------


def plain_print(text):
    w = words(text)
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_components(prints, radius):
    best = dict.fromkeys(prints)
    parent = {i: i for i in best}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and bin(prints[i] ^ prints[j]).count("1") <= radius and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in prints}


def test_simhash_groups_equal_brute_force(docs, rows):
    prints = {r[0]: plain_print(r[1]) for r in rows}
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    groups = plain_components(prints, 3)
    assert got == {i: (prints[i], groups[i]) for i in prints}


def test_simhash_long_text_counts():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 1700, dtype=np.uint64)
    counts = np.array([0, 1, 254, 255, 256, 0, 934])
    at, expected = 0, []
    for n in counts:
        own = h[at : at + n]
        expected.append(sum(1 << k for k in range(64) if 2 * int((own >> np.uint64(k) & np.uint64(1)).sum()) > n))
        at += n
    assert [int(x) for x in simhash.majority(h, counts)] == expected


def test_large_groups_are_cut_again_without_losing_links(spark, monkeypatch):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(3)]
    prints = list({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(60)})
    df = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(prints)], "node long, fp long")
    expected = plain_components(dict(enumerate(prints)), 3)
    for most in (4096, 20):
        monkeypatch.setattr(simhash, "GROUP_ROWS", most)
        got = {r.id: r.component for r in connected_components(simhash.near_edges(df, 3)).collect()}
        assert {i: got.get(i, i) for i in expected} == expected


def test_simhash_of_odd_rows(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count() and all(r.component_id is not None for r in got if r.doc_id is not None)
    assert simhash.near_duplicates(none).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.range(60).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    assert {r.component for r in connected_components(edges.union(edges)).collect()} == {0}


# --- decontamination -------------------------------------------------------------------------------------------------


def plain_leaks(docs, items):
    out = {}
    for d, text in docs:
        w = words(text)
        for i, item in items:
            v = words(item)
            k = min(5, len(v))
            if not v or len(w) < k:
                continue
            gram = lambda x: Counter(tuple(x[s : s + k]) for s in range(len(x) - k + 1))  # noqa: E731, B023
            own, best = gram(v), 0.0
            size = min(len(w), len(v))
            for s in range(len(w) - size + 1):
                there = gram(w[s : s + size])
                same = sum((own & there).values())
                best = max(best, same / (sum(own.values()) + sum(there.values()) - same))
            if best >= 0.8 - 1e-12:
                out[d, i] = round(best, 9)
    return out


def test_leaks_equal_brute_force(spark, none):
    rng = random.Random(6)
    prose = lambda n: [f"w{rng.randint(0, 400)}" for _ in range(n)]
    items = [(i, prose(n)) for i, n in enumerate([14, 25, 40, 59, 300, 4, 1, 30])]
    items[7] = (7, ["la"] * 30)
    docs = []
    for i, v in items[:5]:
        for edit in range(4):
            own = list(v)
            if edit == 1:
                own[len(own) // 2] = "EDIT"
            if edit == 2:
                own.insert(3, "more")
            if edit == 3:
                own = own[len(own) // 2 :] + own[: len(own) // 2]
            docs.append((len(docs), " ".join(prose(20) + [x.upper() if edit == 0 else x for x in own] + prose(20))))
    docs += [(90, " ".join(items[5][1])), (91, items[6][1][0]), (92, " ".join(["la"] * 33)), (93, None), (94, ""), (95, " ".join(items[2][1][:38])), (96, " ".join(prose(60)))]
    bench = [(i, " ".join(v)) for i, v in items] + [(50, None), (51, "")]
    d = spark.createDataFrame([(i, t, "h") for i, t in docs], "doc_id long, text string, hits string")
    b = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id long, text string, words string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontaminate.leaks(d, b).collect()}
    assert got == plain_leaks(docs, bench)
    assert len({k for k, _ in got}) >= 15
    assert decontaminate.leaks(d.union(d), b.union(b)).count() == len(got)
    again = decontaminate.leaks(d.repartition(5), b.repartition(3)).collect()  # ties between windows don't matter
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in again} == got
    long = " ".join(prose(30_000) + items[3][1] + prose(30_000))
    odd = spark.createDataFrame([(None, long), (None, docs[0][1]), (7, long), (7, "clean " * 9)], "doc_id long, text string")
    found = Counter((r.doc_id, r.item_id) for r in decontaminate.leaks(odd, b).collect() if r.item_id not in (5, 6))  # few words are in any long text
    assert found == Counter([(None, 3), (7, 3), (None, 0)])
    assert decontaminate.leaks(none, b).count() == 0 and decontaminate.leaks(d, b.limit(0)).count() == 0


# --- the pipeline ----------------------------------------------------------------------------------------------------


def test_stages_over_odd_rows(spark, odd, none, rows, no_labels):
    """Null and repeated ids, repeated rows, columns with the stages' own names; decisions are taken row by row."""
    import corpus_pipeline as p

    bad = rows[6][1]
    more = spark.createDataFrame([(None, bad, "en", "s0", 1, "x", 1, "y"), (None, "a fine text " * 9, "en", "s0", 1, "x", 1, "y"), (rows[6][0], "another text " * 9, "en", "s0", 1, "x", 1, "y")], odd.schema)
    docs = odd.union(more).withColumn("rid", F.lit(1)).withColumn("size", F.lit(2)).withColumn("kept", F.lit("k"))
    bench = spark.createDataFrame([(1, bad)], "item_id long, text string")
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns and left.where(F.col("text") == bad).isEmpty()
    assert left.count() == docs.where(F.col("text").isNull() | (F.col("text") != bad)).count()
    one = simhash.one_of_each(docs)
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    prints = {(d, t): plain_print(t) for d, t in plain if d is not None}
    names = sorted(prints, key=str)
    groups = plain_components({k: prints[x] for k, x in enumerate(names)}, 3)
    least = defaultdict(list)
    for k, x in enumerate(names):
        least[groups[k]].append(x[0])
    got = Counter(r.doc_id for r in one.where("doc_id is not null").collect())
    assert got == Counter(min(g) for g in least.values()) and one.columns == docs.columns
    assert one.where("doc_id is null").count() == sum(d is None for d, _ in plain)
    from tomewright.llm import cotrain, pii

    assert cotrain.keep_quality(docs, cotrain.fit_quality(docs, no_labels)).count() == docs.count()
    assert pii.mask(docs).columns == docs.columns and mixing.mix(docs).columns == docs.columns
    empty = none.withColumn("rid", F.lit(1))
    assert decontaminate.clean(empty, bench).count() == simhash.one_of_each(empty).count() == pii.mask(empty).count() == mixing.mix(empty).count() == 0
    assert [name for name, _ in p.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii", "mixing"]


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    kept = {r.doc_id for r in p.near_dedup(spark, docs, sf_dir).collect()}
    assert kept == set(groups.values())
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {d for d, _ in plain_leaks([(r.doc_id, r.text) for r in docs.collect()], bench)}
    clean = p.decontaminate(spark, docs, sf_dir)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - bad and clean.columns == docs.columns
    out = p.run(spark, sf_dir)
    assert 0 < out.count() and set(out.columns) == set(docs.columns)
    assert {r.doc_id for r in out.collect()} <= kept
