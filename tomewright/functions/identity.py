"""Identity and hashing: byte-exact ids, ISBN arithmetic, canonical JSON. All JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sha256_text(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def stable_id(prefix: str, *parts: Column) -> Column:
    """prefix, `_` and 20 hex digits of the parts joined by U+001F; a null part counts as empty, not as absent."""
    joined = F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(joined, 256), 1, 20))


def sorted_fields(c: Column, kind: T.DataType) -> Column:
    """The same value with the fields of all its structs in order of their names, so that its JSON is canonical."""
    if isinstance(kind, T.StructType):
        inner = [sorted_fields(c[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(c.isNotNull(), F.struct(*inner))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.transform(c, lambda x: sorted_fields(x, kind.elementType))
    return c


def canonical_json(c: Column, kind: T.DataType) -> Column:
    """JSON with sorted keys and explicit nulls."""
    return F.to_json(sorted_fields(c, kind), {"ignoreNullFields": "false"})


def sha256_json(c: Column, kind: T.DataType) -> Column:
    return sha256_text(canonical_json(c, kind))


def _digit(c: Column, at: int) -> Column:
    return F.substring(c, at, 1).try_cast("int")


def _weighted(c: Column, weights: list[int]) -> Column:
    total = F.lit(0)
    for k, w in enumerate(weights):
        total = total + _digit(c, k + 1) * w
    return total


def isbn10_valid(c: Column) -> Column:
    """Modulus 11; X counts ten and stands last only."""
    last = F.when(F.substring(c, 10, 1) == "X", 10).otherwise(_digit(c, 10))
    total = _weighted(c, list(range(10, 1, -1))) + last
    return F.coalesce(c.rlike("^[0-9]{9}[0-9X]$") & (total % 11 == 0), F.lit(False))


def isbn13_check_digit(stem: Column) -> Column:
    return (10 - _weighted(stem, [1, 3] * 6) % 10) % 10


def isbn13_valid(c: Column) -> Column:
    """Weights 1 and 3, modulus 10; any prefix."""
    last = _digit(c, 13)
    return F.coalesce(c.rlike("^[0-9]{13}$") & (isbn13_check_digit(c) == last), F.lit(False))


def isbn10_to_13(c: Column) -> Column:
    stem = F.concat(F.lit("978"), F.substring(c, 1, 9))
    return F.concat(stem, isbn13_check_digit(stem).cast("string"))


def normalize_isbn(c: Column, length: int) -> Column:
    """Digits and X only, upper case; null unless valid for that length."""
    cleaned = F.upper(F.regexp_replace(c, "[^0-9Xx]", ""))
    if length not in (10, 13):
        return F.lit(None).cast("string")
    return F.when(isbn10_valid(cleaned) if length == 10 else isbn13_valid(cleaned), cleaned)


def isbn_digits(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), "[^0-9X]", "")


def isbn10_matches_13(isbn10: Column, isbn13: Column) -> Column:
    return isbn10_to_13(isbn10) == isbn13


def book_id(isbn10: Column, isbn13: Column, title_key: Column, author_key: Column, provider: Column, external_id: Column) -> Column:
    """ISBN-13, else ISBN-10, else title with first author (both normalized), else provider with its own id."""
    keyed = F.when((F.length(title_key) > 0) & (F.length(author_key) > 0), stable_id("book", title_key, author_key))
    return F.coalesce(F.concat(F.lit("isbn13:"), isbn13), F.concat(F.lit("isbn10:"), isbn10), keyed, stable_id("book", provider, external_id))
