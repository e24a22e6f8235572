"""Text functions. Unicode normalization and markup have no JVM built-in and run in Arrow batches, for those values only
that need it; all else is JVM-side."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bibliographic(value: str | None) -> str | None:
    """Comparison form: NFKC, case folded, letters and digits kept, + and # spelled out, single spaces."""
    if value is None:
        return None
    spelled = {"+": " plus ", "#": " sharp "}
    folded = unicodedata.normalize("NFKC", value).casefold()
    return " ".join("".join(c if c.isalnum() else spelled.get(c, " ") for c in folded).split())


def name_form(value: str | None) -> str | None:
    """NFKC without any white space, case folded."""
    return None if value is None else "".join(unicodedata.normalize("NFKC", value).split()).casefold()


class _Visible(HTMLParser):
    """Visible text by block, with the tag that opened the block."""

    BLOCKS = frozenset("p div li td th tr h1 h2 h3 h4 h5 h6 br ul ol table section article nav header footer body title dd dt".split())
    HIDDEN = frozenset(("script", "style", "noscript", "template"))

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, str]] = []
        self.tag, self.parts, self.hidden = "", [], 0

    def flush(self, tag: str) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((self.tag, text))
        self.tag, self.parts = tag, []

    def handle_starttag(self, tag, attrs):
        if tag in self.HIDDEN:
            self.hidden += 1
        elif tag in self.BLOCKS:
            self.flush(tag)

    def handle_endtag(self, tag):
        if tag in self.HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag in self.BLOCKS:
            self.flush("")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def html_blocks(html: str | None) -> list[tuple[str, str]]:
    """(tag, text) of every visible block of a page; unclosed tags end where the next block begins."""
    parser = _Visible()
    parser.feed(html or "")
    parser.close()
    parser.flush("")
    return parser.blocks


def _arrow(f: Callable[[str | None], object], kind: T.DataType | str):
    @F.pandas_udf(kind)
    def run(values: pd.Series) -> pd.Series:
        return values.map(f, na_action=None)

    return run


#: ASCII white space as Python's str.split() takes it.
SPACES = r"[\x09-\x0D\x1C-\x20]+"


def _split(c: Column, simple: Column, jvm: Column, python: Callable[[str | None], str | None]) -> Column:
    """jvm for simple values; python, in Arrow batches, sees the others only."""
    return F.coalesce(F.when(simple, jvm), _arrow(lambda v: python(v if isinstance(v, str) else None), "string")(F.when(~simple, c)))


def _ascii(c: Column) -> Column:
    return ~c.rlike(r"[^\x00-\x7F]")


def bibliographic_key(c: Column) -> Column:
    spelled = F.replace(F.replace(F.lower(c), F.lit("+"), F.lit(" plus ")), F.lit("#"), F.lit(" sharp "))
    return _split(c, _ascii(c), F.btrim(F.regexp_replace(spelled, "[^a-z0-9]+", " ")), bibliographic)


def name_key(c: Column) -> Column:
    return _split(c, _ascii(c), F.regexp_replace(F.lower(c), SPACES, ""), name_form)


def html_text(c: Column) -> Column:
    """Visible text, blocks on lines of their own."""
    plain = ~c.rlike(r"[<&\x{80}-\x{10FFFF}]")
    return _split(c, plain, F.btrim(F.regexp_replace(c, SPACES, " ")), lambda v: "\n".join(t for _, t in html_blocks(v)))


def clean_title(c: Column) -> Column:
    """White space squeezed; spaces and dots at both ends dropped."""
    return F.btrim(F.regexp_replace(c, r"\s+", " "), F.lit(" ."))


def published_year(c: Column) -> Column:
    """The first year from 1000 to 2199 that stands alone among digits."""
    return F.regexp_extract(c, r"(?<![0-9])(1[0-9]{3}|20[0-9]{2}|21[0-9]{2})(?![0-9])", 1).try_cast("int")


def edition_year(c: Column) -> Column:
    """The first word that is a year from 1500 to 2099."""
    return F.regexp_extract(c, r"\b(1[5-9][0-9]{2}|20[0-9]{2})\b", 1).try_cast("int")


def volume_number(normalized: Column) -> Column:
    return F.regexp_extract(normalized, r"\b(?:volume|vol)\s+([0-9]+)\b", 1).try_cast("int")


#: Spelled edition numbers.
EDITION_WORDS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth")


def edition_numbers(c: Column) -> Column:
    """Sorted distinct edition numbers named in a text, as digits or spelled."""
    low = F.lower(c)
    digits = F.transform(F.regexp_extract_all(low, F.lit(r"\b([0-9]{1,2})(?:st|nd|rd|th)?\s*(?:edition|ed\.?)(?:\b|$)"), F.lit(1)), lambda x: x.cast("int"))
    spelled = F.array_compact(F.array(*[F.when(low.rlike(rf"\b{w}\s+(?:edition|ed\.?)\b"), k + 1) for k, w in enumerate(EDITION_WORDS)]))
    return F.array_sort(F.array_distinct(F.concat(F.coalesce(digits, F.array().cast("array<int>")), spelled)))


def by_statement_authors(c: Column) -> Column:
    """Names of a byline: a leading `by` dropped, split at commas and `and`."""
    line = F.rtrim(F.regexp_replace(F.trim(c), r"(?i)^\s*\[?by\]?\s+", ""))
    return F.filter(F.split(F.regexp_replace(line, r"\.+$", ""), r"\s*(?:,|\band\b)\s*"), lambda x: F.length(x) > 0)


def formula_safe(c: Column) -> Column:
    """A cell that spreadsheets can't take for a formula."""
    return F.when(F.ltrim(c).rlike(r"^[=+\-@]"), F.concat(F.lit("'"), c)).otherwise(c)


def label_value(c: Column) -> Column:
    """yes/true/1: true; no/false/0: false; blank: null; all else is an error."""
    low = F.lower(F.trim(c))
    return F.when(low.isin("yes", "true", "1"), True).when(low.isin("no", "false", "0"), False).when(F.coalesce(low, F.lit("")) == "", F.lit(None).cast("boolean")).otherwise(F.raise_error(F.concat(F.lit("not a label: "), c)))


def joined_title(title: Column, subtitle: Column) -> Column:
    """Title and subtitle with a dash, skipping what is empty."""
    return F.concat_ws(" — ", F.nullif(title, F.lit("")), F.nullif(subtitle, F.lit("")))


def scalar_or_list(scalar: Column, items: Column) -> Column:
    """A list of trimmed nonblank strings from either form."""
    both = F.coalesce(items, F.when(scalar.isNotNull(), F.array(scalar)), F.array().cast("array<string>"))
    return F.filter(F.transform(both, lambda x: F.trim(x)), lambda x: F.length(x) > 0)


def year_bucket(year: Column, bounds: tuple[int, ...]) -> Column:
    """`<=a`, `a+1-b`, ..., `z+1+`; unknown for a null."""
    out = F.when(year.isNull(), "unknown").when(year <= bounds[0], f"<={bounds[0]}")
    for low, high in zip(bounds, bounds[1:], strict=False):
        out = out.when(year <= high, f"{low + 1}-{high}")
    return out.otherwise(f"{bounds[-1] + 1}+")


def cost_estimate(input_tokens: Column, output_tokens: Column, input_rate: float, output_rate: float) -> Column:
    """Cost at rates for a million tokens, to six places."""
    return F.round((input_tokens * input_rate + output_tokens * output_rate) / 1_000_000, 6)


NON_ENGLISH = re.compile("[Ѐ-ӿ؀-ۿ぀-ヿ㐀-鿿가-힯]")
