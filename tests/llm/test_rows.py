"""Operators that judge each row: url filter, quality rules, toxicity, personal data, language, co-training."""

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from tomewright.llm import cotrain, langid, pii, quality_rules, toxicity, url_filter
from tomewright.llm.queries import URL_RULES


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# --- url filter ------------------------------------------------------------------------------------------------------

URLS = [None, "", "no scheme", "http://", "http://A.Example.COM/en/7x?q#f", "http://example.com/en/8", "https://xexample.com/en/1", "http://com/en/", "http://b.net/de/", "http://www.example.net/de/81", "http://x.org/es", "http://x.org/es/ü#/", "ftp://É.com/en/?", "http://notcom/en/", "http://x.com?/en/", "http://example.com/en/7", "http://example.com/en/7"]


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, None, "allow")
    return host, path, best[2], best[3]


@pytest.mark.parametrize("joined", [False, True])
def test_urls_equal_plain_rules(spark, joined):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    got = url_filter.filter_urls_joined(pages, rules) if joined else url_filter.filter_urls(pages, URL_RULES)
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {i: plain(u, URL_RULES) for i, u in enumerate(URLS)}


def test_odd_ids_repeated_rules_and_long_lists(spark, monkeypatch):
    """Null and repeated ids keep their rows, the last verdict by code point holds, and a long list is joined to the same end."""
    rules = [("a.com", "/x", "block"), ("a.com", "/x", "allow"), ("A.com", "/x", "block"), ("b.com", "", "block")]
    urls = [(None, "http://a.com/xy"), (None, "http://b.com"), (1, "http://b.com"), (1, "http://b.com"), (2, None), (3, "http://c.b.com/" + "p/" * 50_000)]
    pages = spark.createDataFrame([(i, u, "r", "v") for i, u in urls], "page_id long, url string, rule string, verdict string")
    want = Counter([(None, "a.com/x", "block"), (None, "b.com", "block"), (1, "b.com", "block"), (1, "b.com", "block"), (2, None, "allow"), (3, "b.com", "block")])
    for size in (1 << 20, 1):
        monkeypatch.setattr(url_filter, "INDEX_BYTES", size)
        assert Counter((r.page_id, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules).collect()) == want


def test_urls_without_rules_and_without_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    assert url_filter.filter_urls(pages, []).first().verdict == "allow"
    assert url_filter.filter_urls(pages.limit(0), URL_RULES).count() == 0


def test_a_collision_does_not_decide(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter, "digest", lambda text: len(text))
    path = tmp_path / "index"
    path.write_bytes(url_filter.build_index([("a.com", "/x", "block"), ("b.com", "/x", "allow")]))
    index = url_filter.DigestIndex(str(path))
    assert index.judge(["b.com", "c.com", "a.com"], ["/x", "/x", "/xy"], "none") == (["b.com/x", None, "a.com/x"], ["allow", "none", "block"])


# --- quality rules ---------------------------------------------------------------------------------------------------


def plain_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_rule_statistics(texts):
    more = ["a b c a b c", "x\nx\n \ny\nx", "#*$ %&|<>\x0b\x1c\x85z", "a a a a"]
    for t in [*texts, *more]:
        assert quality_rules.rule_stats((t or "").encode())[:5] == plain_stats(t), t


def test_rules_over_odd_rows(docs, odd, none, no_labels, rows):
    model = quality_rules.fit_rules(none, no_labels)
    got = by_id(quality_rules.apply_rules(docs, model))
    for i, text, *_ in rows:
        n, *_, repeat = plain_stats(text)
        assert got[i].base_failed == (n < 50 or 100 * repeat > 50 * n) and got[i].kept != got[i].base_failed
    assert quality_rules.apply_rules(odd, model).count() == odd.count()
    assert quality_rules.apply_rules(none, model).count() == 0


def test_forest_on_labelled_rows_it_has_not_seen(spark, sf_dir):
    """Of the low rows that pass the hard rules most go, of the good ones few; half of the rows are unknown to the forest."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    own = labels.where("crc32(cast(cast(doc_id as string) as binary)) % 3 > 0")
    got = quality_rules.apply_rules(docs, quality_rules.fit_rules(docs, own)).where("not base_failed").join(labels, "doc_id")
    held = got.where("crc32(cast(cast(doc_id as string) as binary)) % 3 = 0").select("quality", "kept").collect()
    low, good = [r.kept for r in held if not r.quality], [r.kept for r in held if r.quality]
    assert np.mean(good) >= 0.97 and (not low or np.mean(low) <= 0.5)


def test_forest_finds_outliers():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (500, 4)), rng.normal(9, 1, (15, 4))])
    forest = quality_rules.IsolationForest.grow(x[:250])
    s = forest.score(x)
    for row in range(0, 515, 60):  # path lengths by walking each tree
        total = 0.0
        for feature, low, value, high, left, depth in forest.trees:
            k = 0
            while feature[k] >= 0 and low[k] <= x[row, feature[k]] <= high[k]:
                k = left[k] + (x[row, feature[k]] > value[k])
            total += depth[k]
        assert abs(s[row] - 2 ** (-total / len(forest.trees) / forest.usual)) < 1e-12
    assert np.sort(s[500:])[2] > np.quantile(s[:500], 0.97)
    at = quality_rules.calibrate(s, np.arange(515) < 500, 0.01)
    assert (s[:500] > at).mean() <= 0.01


# --- toxicity --------------------------------------------------------------------------------------------------------


def toxic_table(spark, n=400):
    rng = np.random.default_rng(1)
    words = [f"w{chr(97 + i)}{chr(97 + k)}" for i in range(12) for k in range(6)]
    rows, labels = [], []
    for i in range(n):
        own = list(rng.choice(words, 30))
        bad = i % 6 == 0
        if bad:
            own[3] = str(rng.choice(["vile", "rotten"]))
        if i % 4 == 0:
            own[10] = "women" if bad or i % 8 else "men"  # mentioned in toxic rows more often
        rows.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_rows_and_neutral_mentions(spark, none, no_labels):
    docs, labels = toxic_table(spark)
    model = toxicity.fit_toxicity(docs, labels)
    got = by_id(toxicity.score_toxicity(docs, model))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [i for i in got if got[i].held_out]
    assert {i for i in got if got[i].held_out} == {i for i in got if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.95
    a, b, c = (model.score(toxicity.words(t)) for t in ("the women of wab", "the men of wab", "the of wab"))
    assert abs(a - b) < 0.02 and max(a, b) < 0.3 and c < 0.3
    assert model.score({"vile"}) > 0.3
    free = toxicity.fit_toxicity(docs, labels, fairness=0.0)
    gap = lambda m: abs(m.weights["women"] - m.weights["men"])
    assert gap(model) < 0.5 * gap(free)  # the counterfactual term acts
    wrong = lambda m: np.mean([m.score({f"w{chr(97 + i)}a", "women"}) - m.score({f"w{chr(97 + i)}a", "men"}) for i in range(12)])
    assert abs(wrong(model)) < abs(wrong(free))
    empty = toxicity.fit_toxicity(docs, no_labels)
    assert {r.predicted for r in toxicity.score_toxicity(docs.limit(5), empty).collect()} <= {0, 1}
    assert toxicity.score_toxicity(none, model).count() == 0


def test_every_toxic_word_with_support_has_a_weight(spark):
    rng = np.random.default_rng(7)
    neutral = [f"w{chr(97 + i)}{chr(97 + k)}" for i in range(20) for k in range(20)]
    insults = [f"vile{chr(97 + i)}" for i in range(10)]
    own = [list(rng.choice(neutral, 30)) + (list(rng.choice(insults, 3, replace=False)) if i % 8 == 0 else []) for i in range(400)]
    docs = spark.createDataFrame([(i, " ".join(ws)) for i, ws in enumerate(own)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert all(model.score({w}) > 0.3 for w in insults)
    got = by_id(toxicity.score_toxicity(docs, model))
    assert all(got[i].predicted == (i % 8 == 0) for i in got if got[i].held_out and i % 8 == 0)
    assert np.mean([got[i].predicted == 0 for i in got if got[i].held_out and i % 8]) > 0.95


def test_toxicity_of_odd_rows(odd):
    got = toxicity.score_toxicity(odd, toxicity.ToxicModel(-3.0, {"one": 6.0})).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)


# --- personal data ---------------------------------------------------------------------------------------------------


def plain_base(text):
    def luhn(d):
        odd, even = d[-1::-2], d[-2::-2]
        return (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(x)))) for x in even)) % 10 == 0

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m[0])
        out += [("card", *m.span())] if 16 <= len(d) <= 19 and luhn(d) else []
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return out


PRIVATE = ["a.b@c.de, x@y.z.", "1.2.3.4.5.6 999.1.1.1 0255.1.2.3", "4111 1111-1111 1111 12", "+1 (974) 555-3436. +12", "é +49 30 1234567 u@v.w", "", None, "@@ a@b a@b.c@d.e", "٣٤ 5", "4012888888881881", "Call (415) 555-2671 or bob (at) mail (dot) org", "9" * 3000]


def test_personal_data_base_and_more(spark):
    df = spark.createDataFrame([(i, t, "e") for i, t in enumerate(PRIVATE)], "doc_id long, text string, spans string")
    got = by_id(pii.find_pii(df))
    for i, t in enumerate(PRIVATE):
        base = plain_base(t or "")
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(b[0] == k for b in base) for k in pii.KINDS], t
        assert pii.base_spans(t or "") == base
        assert set(filter(None, pii.joined(base).split(","))) <= set(filter(None, got[i].spans.split(",")))
    assert got[10].spans == "email:23:46,phone:5:19"
    assert got[7].n_email == len(plain_base(PRIVATE[7]))


def test_personal_data_in_runs_without_end():
    """Texts that make backtracking patterns slow: each is judged like a short one, and soon."""
    many = "mail a.b@c.de or +1 974 555 3436 from 10.0.0.1 \n"
    for text in ("a" * 1_000_000 + "@", "7" * 1_000_000, "1." * 300_000, "@" * 300_000, "0" * 5000 + ".1.1.1 ", many * 4000, "+1 " + "( " * 300_000, "a@" * 200_000):
        began = time.perf_counter()
        spans = pii.base_spans(text)
        assert time.perf_counter() - began < 2, text[:20]
        assert [x[0] for x in spans].count("email") == text.count("a.b@c.de")
    assert ("ip", 0, 5006) in pii.base_spans("0" * 5000 + ".1.1.1 ")
    began = time.perf_counter()
    base, every = pii.all_spans([many * 4000])[0]
    assert time.perf_counter() - began < 20 and set(base) <= set(every) and len(base) == 12_000
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("ab.@_ -1%") for _ in range(rng.randint(0, 25)))
        assert [s for s in pii.base_spans(text) if s[0] in ("email", "ip")] == [s for s in plain_base(text) if s[0] in ("email", "ip")], text


#: Spellings that the training table doesn't have, and sentences without personal data.
UNSEEN = (
    ("Please mail tom.jones (at) uni (dot) edu today", "email"), ("email: lisa [at] posteo [dot] net now", "email"), ("contact maria at firma dot org please", "email"),
    ("Mail nina_w [at] data.example.com for the file", "email"), ("write to office (at) town (dot) gov soon", "email"), ("email kurt at example dot net and wait", "email"),
    ("Call (646) 555-0123 after nine", "phone"), ("our fax is 718-555-0164 , thanks", "phone"), ("phone: 303 555 0178 today", "phone"), ("tel 0161 496 0345 or ask", "phone"),
    ("Mobile 07911 123 456 before six", "phone"), ("call 1-888-555-0142 now", "phone"), ("by phone at 415.555.0199 every day", "phone"), ("Call (702) 555-0101 or (702) 555-0102", "phone"),
    ("card 3714 496353 98431 was charged", "card"), ("Visa 4111.1111.1111.1111 please", "card"), ("card number 5105.1051.0510.5100 is new", "card"),
)
HARMLESS = (
    "In 2003 there were 14,200 units at 5.25 each.", "See version 3.1 . 2 of the paper , page 40 .", "the result ( 45 ) is at the end", "we are at the dot of noon",
    "scores 2-1 , 5-3 and 11-8", "isbn 978-0-306-40615-7 is old", "ids 110 220 330 440 550 660", "on 2023-11-02 at 09:15:00 it began", "between 1990 and 2005 , 30 of 45 were lost",
)


def test_the_field_finds_spellings_it_was_not_shown():
    found = pii.all_spans([t for t, _ in UNSEEN])
    hit = [any(s[0] == kind and s not in base for s in every) for (_, kind), (base, every) in zip(UNSEEN, found, strict=True)]
    assert np.mean(hit) >= 0.9, [t for (t, _), h in zip(UNSEEN, hit, strict=True) if not h]
    assert not any(every for _, every in pii.all_spans(list(HARMLESS)))


def test_masking_and_odd_rows(spark, odd, none):
    df = spark.createDataFrame([(1, "to a@b.cd now", 13, "k"), (2, None, None, "k")], "doc_id long, text string, n_chars long, other string")
    assert [tuple(r) for r in pii.mask(df).orderBy("doc_id").collect()] == [(1, "to [EMAIL] now", 14, "k"), (2, None, None, "k")]
    assert pii.mask(odd).count() == odd.count() and pii.find_pii(none).count() == 0


def test_whole_texts_are_decoded():
    far = "Please email info at example dot com for more"
    cut = "12 , " * 199 + "call (212) 555-0187 before noon."
    for text, kind, part in ((far, "email", "info at example dot com"), (cut, "phone", "(212) 555-0187")):
        at = text.index(part)
        assert (kind, at, at + len(part)) in pii.all_spans([text])[0][1]
    assert pii.masked(far, pii.all_spans([far])[0][1]) == "Please email [EMAIL] for more"


def test_training_table_is_decoded_as_marked():
    rows = [pii._example(s) for s in pii.SENTENCES]
    assert pii.viterbi([r[0] for r in rows]) == [r[1] for r in rows]


def test_viterbi_is_exact():
    from itertools import product

    weight, move = pii.fit_crf()
    for run in ([3, 40, 2], [pii.PLACE["("], pii.PLACE["d3"], pii.PLACE[")"], pii.PLACE["d3"]]):
        e = pii._emissions(weight, np.array([run]))[0]
        value = lambda y: sum(e[t, k] for t, k in enumerate(y)) + sum(move[a, b] for a, b in zip(y, y[1:], strict=False))  # noqa: E731, B023
        best = max(product(range(len(pii.LABELS)), repeat=len(run)), key=value)
        assert abs(value(pii.viterbi([run])[0]) - value(best)) < 1e-9


# --- language --------------------------------------------------------------------------------------------------------

SAMPLES = {"en": "the cat and the dog were in the house with other things", "fr": "le chat et les chiens sont dans la maison avec des choses", "de": "die katze und der hund sind mit den sachen in dem haus"}


def language_table(spark, n=240):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        lang = list(SAMPLES)[i % 3]
        rows.append((i, " ".join(rng.choice(SAMPLES[lang].split(), 12)), lang))
    rows += [(900, None, "en"), (901, "12 %", "fr"), (902, "", None), (903, "the dog", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_on_held_out_rows(spark, none):
    docs = language_table(spark)
    model = langid.fit_languages(docs)
    got = by_id(langid.identify(docs, model))
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in got if got[i].held_out and i < 900]
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.97
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "en"] and got[902].score == 0
    assert {r.lang_pred for r in langid.identify(docs, langid.fit_languages(none)).collect()} == {"und"}


def plain_kneser_ney(texts, codes):
    """log p(last | first three) by the definition, for grams of four codes; codes: how many characters all languages have."""
    d = langid.DISCOUNT
    level = {4: Counter()}
    for t in texts:
        c = "   " + "".join(x.lower() if x.isalpha() else " " for x in t)
        level[4].update(c[i : i + 4] for i in range(len(c) - 3))
    for o in (3, 2, 1):
        level[o] = Counter(g[1:] for g in level[o + 1])

    def p(g):
        if not g:
            return 1 / (codes + 1)
        own = {x: n for x, n in level[len(g)].items() if x[:-1] == g[:-1]}
        if not own:
            return p(g[1:])
        return (max(own.get(g, 0) - d, 0) + d * len(own) * p(g[1:])) / sum(own.values())

    return lambda g: float(np.log(p(g)))


def test_models_equal_kneser_ney_by_definition(spark):
    texts = {"x": ["abracadabra banana", "a cab 12", "𐌰𐌱 ab"], "y": ["bcd bcd", "éa"], "z": ["q"]}
    docs = spark.createDataFrame([(i, t, lang) for lang, ts in texts.items() for i, t in enumerate(ts)], "doc_id long, text string, lang string")
    model = langid.publish(langid.estimate(langid.count_grams(docs)))
    assert model.langs == ["x", "y", "z"]
    plain_texts = {lang: [t.replace("𐌰", chr(0xE000)).replace("𐌱", chr(0xE001)) for t in ts] for lang, ts in texts.items()}
    coded = {lang: [langid.encode([t])[0][3:] for t in ts] for lang, ts in texts.items()}
    assert len(set(coded["x"][2][:2]) | {32}) == 3 and plain_texts  # far letters are letters
    kinds = len({int(c) for cs in coded.values() for one in cs for c in one} | {32})
    rng = random.Random(2)
    for k, lang in enumerate(("x", "y", "z")):
        if lang == "x":
            continue  # has far letters, which the plain version spells otherwise
        plain = plain_kneser_ney(texts[lang], kinds)
        grams = ["".join(rng.choice("abcdq é") for _ in range(4)) for _ in range(60)]
        keys = np.array([sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(g)) for g in grams], np.uint64)
        assert np.allclose(model.per_char(k, keys), [plain(g) for g in grams], atol=1e-5)
    for context in ("abr", "ana", "zzz"):
        head = sum(ord(c) << (16 * (3 - k)) for k, c in enumerate(context))
        every = sorted({int(c) for cs in coded.values() for one in cs for c in one} | {32, 0x2345})
        assert abs(np.exp(model.per_char(0, np.array([head + c for c in every], np.uint64))).sum() - 1) < 1e-4


def test_language_of_odd_rows(spark, odd, docs):
    """Far letters are letters; null ids are held out; repeated rows and long texts are judged like others; no language goes."""
    rows = [(i, "the cat and the dog", "en") for i in range(40)] + [(50 + i, "le chat et le chien", "fr") for i in range(40)]
    rows += [(i, "𐌰𐌱𐌲 𐌳𐌴", "got") for i in range(200, 203)] + [(300, "der hund", "de")]
    model = langid.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en", "fr", "got"] or model.langs == ["en", "fr", "got"]  # 300 may be held out
    ask = [(1, "𐌰𐌱𐌲"), (2, "𠀀"), (3, "the dog " * 100_000), (4, "the dog"), (4, "the dog"), (None, "the dog"), (6, "١٢ !"), (7, "")]
    got = langid.identify(spark.createDataFrame([(i, t, "n") for i, t in ask], "doc_id long, text string, lang_pred string"), model).collect()
    assert [r.lang_pred for r in got] == ["got", got[1].lang_pred, "en", "en", "en", "en", "und", "und"] and got[1].lang_pred != "und"
    assert got[5].held_out and all(0 <= r.score <= 1 for r in got)
    assert langid.identify(odd, model).count() == odd.count() and langid.identify(docs, model).count() == docs.count()


# --- co-training -----------------------------------------------------------------------------------------------------


def test_cotraining(spark, odd, none, no_labels):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        words = [f"w{rng.integers(500)}" + ("##%" if bad and k % 3 else "") for k in range(40)]
        rows.append((i, " ".join(words), "en", "junk" if bad and i % 2 else f"s{i % 4}", None))
        if i % 2:
            labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string")
    model = cotrain.fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = by_id(cotrain.score_quality(docs, model))
    assert np.mean([got[i].kept == (i % 5 > 0) for i in got]) > 0.97
    assert cotrain.score_quality(odd, model).count() == odd.count()
    assert cotrain.score_quality(docs.union(docs).limit(3).selectExpr("doc_id", "repeat('a b ', 200000) as text", "lang", "source"), model).count() == 3
    free = cotrain.fit_quality(none, no_labels)
    assert all(r.kept and r.score == 0.5 for r in cotrain.score_quality(odd, free).collect())
    assert cotrain.score_quality(none, model).count() == 0


def test_words_alone_tell_quality_of_held_out_rows(spark):
    """Low rows differ from good ones in their words only; the evidence of words must find them."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice([f"w{chr(97 + k)}{chr(97 + j)}" for k in range(20) for j in range(20)], 60)) + (" buy cheap pills" if i % 6 == 0 else " as was said"), "en", f"s{i % 3}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i % 6 > 0)) for i in range(0, 600) if zlib.crc32(str(i).encode()) % 3], "doc_id long, quality int")
    model = cotrain.fit_quality(docs, labels)
    got = by_id(cotrain.score_quality(docs, model))
    held = [i for i in got if zlib.crc32(str(i).encode()) % 3 == 0]
    assert np.mean([got[i].kept == (i % 6 > 0) for i in held]) > 0.95


def test_taught_counts_equal_plain_counts(spark):
    rows = [(i, f"a b c{i % 4} " * (1 + i % 3), "en", f"s{i % 2}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    pool = cotrain.with_views(docs, ("doc_id",))
    table = pool.toArrow()
    own = cotrain.Rows.of({x: table.column(x) for x in table.column_names})
    rng = np.random.default_rng(1)
    views = tuple(cotrain.Logistic(np.zeros(n), np.ones(n), rng.normal(0, 1, n + 1)) for n in (own.view(0, np.zeros(40)).shape[1], own.view(1, np.zeros(40)).shape[1]))
    model = cotrain.QualityModel(views, (rng.normal(0, 1, cotrain.WORDS), rng.normal(0, 1, cotrain.META)), None, None, 0.0)
    got = cotrain.taught(pool, model, [3, 4], 0.6)
    ids = table.column("doc_id").to_pylist()
    for view in (0, 1):
        p = 1 / (1 + np.exp(-model.of_view(1 - view, own)))
        ends, tokens = own.tokens(view)
        expected = np.zeros_like(got[view])
        for r in range(40):
            if ids[r] not in (3, 4) and (p[r] > 0.6 or p[r] < 0.4):
                k = int(p[r] < 0.4)
                expected[k, -1] += 1
                for t in tokens[ends[r] : ends[r + 1]]:
                    expected[k, t] += 1
        assert (got[view] == expected).all()
