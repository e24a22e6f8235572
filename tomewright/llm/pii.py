"""Personal data by patterns and a linear-chain conditional random field.

The patterns find e-mail addresses, IP addresses, payment cards (Luhn) and phone numbers in their plain forms. A
linear-chain CRF over word-shape features finds further spellings (phone numbers without a plus, addresses spelled
with "at" and "dot", cards in other groupings). It is trained from a small labelled table of sentences below and
decoded by Viterbi over all tokens of each whole text, many texts at once, in numpy. A span of the CRF is added where
its digits or parts make it possible and no pattern's span overlaps; pattern spans always stay.

Spans are (kind, start, end) in code points, end exclusive. Null and empty texts have none. Repeated rows are judged
alike, null ids like others; an empty table gives none. Time grows with a text's length, whatever it holds. Only doc_id
and text are read, and the other columns by mask() only, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.llm.common import released

KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")  # a match can't begin within a number
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+ from left to right, in time linear in the text.

    All before an @ that can be in a match stands in one run, and another start in it would fail alike.
    """
    free = at = 0  # a match may begin here; the text behind the last @
    while (here := text.find("@", at)) >= 0:
        run = text[max(free, at) : here]
        begin = max(free, at) + len(run.rstrip(LOCAL))
        at = here + 1
        if begin < here and (m := DOMAIN.match(text, here)):
            yield "email", begin, m.end()
            free = m.end()


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by kind and start."""
    out: list[Span] = list(_emails(text))
    if DIGIT.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x[-3:]) < 256 for x in m.groups())]
        out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return out


# --- the random field ----------------------------------------------------------------------------------------------

TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\s]")
CUES = ("at", "dot", "call", "phone", "tel", "fax", "mobile", "card", "visa", "mail", "email", "version", "page", "year", "isbn", "com", "org", "net", "edu", "gov", "or", "and")
MARKS = "()[]-.+@,:;/_#$%"
#: Word shapes: numbers by length, cue words, other words by length and case, marks.
SHAPES = ["<edge>", *(f"d{k}" for k in (1, 2, 3, 4, 5, 6, 7)), *CUES, "x", "Xx", "X", "xx", *MARKS, "?"]
PLACE = {s: i for i, s in enumerate(SHAPES)}
REACH = 2
#: Tokens that are decoded together, if no single text has more, and rows that are judged together.
TOGETHER, ROWS = 1 << 18, 1000
LABELS = ("O", *KINDS)
#: Code points that an address or number has at most; the longest valid e-mail address has 320.
LONGEST = 400


def shape(token: str) -> int:
    if "0" <= token[0] <= "9":
        return PLACE[f"d{min(7, len(token))}"]
    low = token.lower()
    if low in CUES:
        return PLACE[low]
    if token[0].isalpha():
        return PLACE["X" if token.isupper() else "Xx" if token[0].isupper() else "xx" if len(token) > 3 else "x"]
    return PLACE.get(token, PLACE["?"])


#: A small labelled table: {kind:...} marks a span.
SENTENCES = (
    "Please call {phone:(212) 555-0187} before noon.", "Our fax is {phone:415-555-0132}, thanks.", "tel {phone:020 7946 0958} or ask at the desk",
    "phone: {phone:555 867 5309} today", "Mobile {phone:07700 900 123} after six", "call {phone:1-800-555-0199} now and then {phone:(303) 555-0100}",
    "You reach us by phone at {phone:646.555.0143} every day", "tel. {phone:(0) 30 901820}", "Fax {phone:312 555 0111} ext 4",
    "write to {email:anna.lee [at] mail [dot] example [dot] com} soon", "mail {email:bob (at) example (dot) org} please", "email {email:info at example dot com} for more",
    "contact {email:j smith_77 [at] corp.example.net} now", "{email:sales (at) shop.example.com} answers", "Mail: {email:kim[at]example.org}",
    "card {card:4111-1111-1111-1111} was charged", "Visa {card:4012 8888 8888 1881} please", "card number {card:3782 822463 10005} exp 04", "the card {card:5555.5555.5555.4444} is new",
    "Please mail {email:p.smith (at) school (dot) edu} this week", "mail {email:eva (at) lab (dot) org} or {email:leo [at] lab [dot] org}", "email: {email:omar [at] web [dot] com} later",
    "write to {email:desk (at) city (dot) gov} now", "ask {email:mia.k [at] mail (dot) net} and wait", "contact {email:help (at) corp (dot) com} please", "{email:news [at] paper [dot] net} is read daily",
    "Call {phone:(404) 555-0133} or {phone:(404) 555-0134} today", "phone {phone:212-555-0170} or {phone:212-555-0171}", "tel {phone:0131 496 0777} and {phone:0131 496 0778}", "dial {phone:(512) 555 0190} , please",
    "host {ip:10.0.0.12} answered", "ping {ip:192.168.1.254} twice", "server {ip:172.16.254.1} is down",
    "In 1999 there were 12 , 500 units sold at 3.50 each .", "See version 2.0 . 1 of the license , page 12 .", "licensed under CC BY-NC 4.0.",
    "It rose by 4.5 % to 1,234,567 in 2021 .", "Chapter 3.2.1 begins at page 104 .", "the result ( 12 ) and ( 34 ) are at the end", "isbn 978-3-16-148410-0 is a book",
    "token = 04dbebab91ab85687d33eeaaf9ac699e1188f962", "on 2024-05-17 at 10:45:30 we met", "order 9807915762804490 was lost", "we are at the dot of dawn", "look at this @ once",
    "room 212 , floor 3 , box 555", "scores 3-2 , 4-1 and 10-9", "the year 2020 - 2021 was long", "$ 1 200 000 and 300 500 more", "ids 100 200 300 400 500 600", "Version 10.2.3.4 . 5 is out",
)


def _example(marked: str) -> tuple[list[int], list[int]]:
    text, spans, at = "", [], 0
    for m in re.finditer(r"\{(\w+):([^}]*)\}", marked):
        text += marked[at : m.start()]
        spans.append((len(text), len(text) + len(m[2]), LABELS.index(m[1])))
        text, at = text + m[2], m.end()
    text += marked[at:]
    shapes, labels = [], []
    for m in TOKEN.finditer(text):
        shapes.append(shape(m[0]))
        labels.append(next((k for s, e, k in spans if s <= m.start() < e), 0))
    return shapes, labels


def _emissions(weight: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Scores (run, token, label) from the shapes around each token; runs is padded with edges."""
    wide = np.pad(runs, ((0, 0), (REACH, REACH)))
    return sum(weight[k, wide[:, k : k + runs.shape[1]]] for k in range(2 * REACH + 1))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


@lru_cache(maxsize=1)
def fit_crf(steps: int = 250, ridge: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights (offset, shape, label) and transitions, by maximum likelihood; the same in every process."""
    rows = [_example(s) for s in SENTENCES]
    size, n = max(len(r[0]) for r in rows), len(LABELS)
    x, y = np.zeros((len(rows), size), int), np.zeros((len(rows), size), int)
    on = np.zeros((len(rows), size), bool)
    for i, (a, b) in enumerate(rows):
        x[i, : len(a)], y[i, : len(b)], on[i, : len(a)] = a, b, True
    wide = np.pad(x, ((0, 0), (REACH, REACH)))
    weight, move = np.zeros((2 * REACH + 1, len(SHAPES), n)), np.zeros((n, n))
    sums = [np.zeros_like(weight), np.zeros_like(move)]
    for _ in range(steps):
        e = _emissions(weight, x)
        ahead, back = np.zeros_like(e), np.zeros_like(e)
        ahead[:, 0] = e[:, 0]
        for t in range(1, size):
            step = _logsum(ahead[:, t - 1, :, None] + move, 1) + e[:, t]
            ahead[:, t] = np.where(on[:, t, None], step, ahead[:, t - 1])
        for t in range(size - 2, -1, -1):
            step = _logsum(move + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(on[:, t + 1, None], step, 0)
        z = _logsum(ahead[:, -1], 1)
        p = np.exp(ahead + back - z[:, None, None]) * on[:, :, None]
        g = p - np.eye(n)[y] * on[:, :, None]
        gw, gm = ridge * weight, ridge * move
        for k in range(2 * REACH + 1):
            np.add.at(gw[k], wide[:, k : k + size].ravel(), g.reshape(-1, n))
        for t in range(1, size):
            both = np.exp(ahead[:, t - 1, :, None] + move + (e[:, t] + back[:, t])[:, None, :] - z[:, None, None]) * on[:, t, None, None]
            gm += both.sum(0)
            np.subtract.at(gm, (y[on[:, t], t - 1], y[on[:, t], t]), 1)
        for v, d, s in ((weight, gw, sums[0]), (move, gm, sums[1])):
            s += d * d
            v -= 0.3 * d / (np.sqrt(s) + 1e-8)
    return weight, move


def viterbi(runs: list) -> list[list[int]]:
    """The best labels of each run of shapes; runs of like length are decoded together."""
    weight, move = fit_crf()
    out: list[list[int]] = [[] for _ in runs]
    order = sorted((i for i in range(len(runs)) if len(runs[i])), key=lambda i: -len(runs[i]))
    lo = 0
    while lo < len(order):
        size = len(runs[order[lo]])
        part = order[lo : lo + max(1, min(1024, TOGETHER // size))]
        lo += len(part)
        n = np.array([len(runs[i]) for i in part])
        x = np.zeros((size + 2 * REACH, len(part)), np.uint8)  # edges around
        for k, i in enumerate(part):
            x[REACH : REACH + n[k], k] = np.frombuffer(bytes(runs[i]), np.uint8)
        on = np.searchsorted(-n, -np.arange(size + 1)).tolist()  # the runs that have a token there come first
        score = np.empty((size, len(LABELS), len(part)))
        stretch = max(16, (1 << 17) // len(part))
        for at in range(0, size, stretch):
            end = min(at + stretch, size)
            e = sum(np.take(weight[k].T, x[at + k : end + k], axis=1) for k in range(2 * REACH + 1))
            for t in range(at, end):
                m = on[t]
                score[t, :, :m] = (score[t - 1, :, None, :m] + move[:, :, None]).max(0) + e[:, t - at, :m] if t else e[:, 0, :m]
        best, now = np.zeros((size, len(part)), np.uint8), np.zeros(len(part), int)
        for t in range(size - 1, -1, -1):
            later, m = on[t + 1], on[t]
            now[:later] = (score[t, :, :later] + move[:, now[:later]]).argmax(0)
            now[later:m] = score[t, :, later:m].argmax(0)
            best[t, :m] = now[:m]
        for k, i in enumerate(part):
            out[i] = best[: n[k], k].tolist()
    return out


class _Shapes(dict):
    """Shapes of tokens; so many are remembered."""

    def __missing__(self, token: str) -> int:
        found = shape(token)
        if len(self) < 100_000:
            self[token] = found
        return found


_shapes = _Shapes()


def possible(kind: str, text: str) -> bool:
    d = digits_of(text)
    if kind == "phone":
        return 9 <= len(d) <= 15 and bool(re.search(r"[ ().-]", text)) and not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}.*", text)
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    if kind == "email":
        return bool(re.fullmatch(r"[\w.%+-]+(?: [\w.%+-]+)?\s?(?:[\[(]\s?at\s?[\])]|\bat\b|@)\s?[\w-]+(?:\s?(?:\.|[\[(]\s?dot\s?[\])]|\bdot\b)\s?[\w-]+)+", text, re.I))
    return bool(re.fullmatch(r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}", text)) and all(int(x) < 256 for x in text.split("."))


def all_spans(texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """For each text the spans of the patterns, and all spans with those of the field, by kind and start.

    A span of the field that overlaps one of the patterns is left out; those of the field don't overlap each other.
    """
    base = [base_spans(t) for t in texts]
    more: list[list[Span]] = [[] for _ in texts]
    for i, best in enumerate(viterbi([bytes(map(_shapes.__getitem__, TOKEN.findall(t))) for t in texts])):
        if not any(best):
            continue
        own, at, near, reach = list(TOKEN.finditer(texts[i])), 0, 0, 0
        begins = sorted(base[i], key=lambda x: x[1])
        while at < len(own):
            end = at + 1
            while end < len(own) and best[end] == best[at]:
                end += 1
            if best[at]:
                s, e = own[at].start(), own[end - 1].end()
                while near < len(begins) and begins[near][1] < e:  # reach: the furthest end of those that begin before e
                    reach, near = max(reach, begins[near][2]), near + 1
                if reach <= s and e - s <= LONGEST and possible(LABELS[best[at]], texts[i][s:e]):
                    more[i].append((LABELS[best[at]], s, e))
            at = end
    order = lambda spans: sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1]))
    return [(b, order(b + m)) for b, m in zip(base, more, strict=True)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_pii(documents: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row; the counts are those of the patterns."""
    own = documents.select("doc_id", "text")
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                found = all_spans([t or "" for t in part.column(1).to_pylist()])
                counts = [pa.array([sum(x[0] == k for x in f[0]) for f in found], pa.int64()) for k in KINDS]
                sha = pa.array([hashlib.sha256(joined(f[0]).encode()).hexdigest() for f in found], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *counts, sha, pa.array([joined(f[1]) for f in found], pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return own.mapInArrow(lambda batches: released(run(batches)), f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by [KIND]; of overlapping ones the whole stretch by the first's kind."""
    out, at, open_to = [], 0, -1
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= open_to:
            out += [text[at:s], f"[{kind.upper()}]"]
            open_to = e
        open_to = max(open_to, e)
        at = open_to
    return "".join([*out, text[at:]])


def mask(documents: DataFrame) -> DataFrame:
    """The documents with personal data replaced in text; n_chars, if there, follows. All columns stay."""
    names, schema = documents.columns, documents.schema
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                texts = part.column(at).to_pylist()
                found = all_spans([t or "" for t in texts])
                new = [None if t is None else masked(t, f[1]) for t, f in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if k == at else c for k, c in enumerate(part.columns)], names)

    out = documents.mapInArrow(lambda batches: released(run(batches)), schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in names else out
