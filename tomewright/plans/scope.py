"""What a search may collect: fields and their names, scopes of a query and a category, provider queries, audited responses.

The registry of fields is given by the caller: id to a dict of name, aliases, queries and patterns. Scopes are a few
values, made on the driver; decisions on candidates are column expressions.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.operators.decisions import accepted
from tomewright.plans import providers
from tomewright.plans.providers import Topic

#: Categories of the bookstore that searches may be bound to, with what subjects of theirs look like.
CATEGORIES = {
    "경제 경영": r"\beconom(?:y|ic|ics)\b|\bbusiness\b|\bfinance\b|\bmanagement\b|\bcommerce\b",
    "IT 모바일": r"\bcomput\w*|\bsoftware\b|\bprogramming\b|\binformation technology\b",
    "자연과학": r"\bscien\w*|\bmathemat\w*|\balgebra\b|\bphysics\b|\bbiology\b|\bchemistry\b",
    "인문": r"\bphilosoph\w*|\bhumanities\b|\blinguistic\w*|\blanguage\b",
    "사회 정치": r"\bsocial\b|\bpolitic\w*|\bsociolog\w*",
    "대학교재": None, "어린이": None, "청소년": None,
}
BOOK_KINDS, AUDIENCES = {"대학교재": "textbook"}, {"어린이": "children", "청소년": "teen"}
ROOT, MOST = "국내도서", 30
#: Subjects that a search asks for beside its phrase.
ASKED = {"textbook": "subject:textbooks", "children": "subject:juvenile", "teen": 'subject:"young adult"'}


def name_key(text: str) -> str:
    """Names that differ in width, case or spaces only are one."""
    return "".join(unicodedata.normalize("NFKC", text).split()).casefold()


@dataclass(frozen=True)
class Scope:
    query: str
    category: str | None
    subject: str | None
    english_query: str | None
    evidence: str | None
    book_kind: str | None
    audience: str | None
    basis: str
    status: str
    category_pattern: str | None = None
    version: str = "query-scope-v1"

    def ready(self) -> "Scope":
        if self.status != "ready" or not self.english_query or not self.evidence:
            raise ValueError(f"the scope of {self.query!r} can't be collected abroad: {self.status}")
        return self


def resolve_field(registry: dict[str, dict], query: str) -> str | None:
    """The field that a query names by id or alias; two are an error."""
    found = [k for k, f in registry.items() if name_key(query) in map(name_key, (k, *f["aliases"]))]
    if len(found) > 1:
        raise ValueError(f"{query!r} names several fields: {', '.join(sorted(found))}")
    return found[0] if found else None


def field_scope(registry: dict[str, dict], key: str) -> Scope:
    """The scope of a reviewed field: its own query and pattern, and no category."""
    f = registry[key]
    return Scope(f["korean_query"], None, key, f["english_query"], f["evidence_pattern"], None, None, "reviewed_common_field", "ready", version="common-field-scope-v1")


def field_topic(registry: dict[str, dict], key: str) -> Topic:
    f = registry[key]
    return Topic(f"field-{key}", f["domain"], f["evidence_pattern"], category=f.get("korean_category_pattern"), discovery=True, extra={"title": f["name"], "korean_query": f["korean_query"], "korean_pattern": f["korean_evidence_pattern"]})


def query_scope(query: str, category: str, registry: dict[str, dict], topics: dict[str, Topic]) -> Scope:
    """Reviewed names first: of fields, then of topics; an English phrase stands for itself; else the query has no English."""
    subject = english = pattern = None
    basis = "unmapped"
    if key := next((k for k, f in registry.items() if name_key(query) in map(name_key, f["aliases"])), None):
        subject, english, pattern, basis = key, registry[key]["english_query"], registry[key]["evidence_pattern"], "reviewed_alias"
    elif t := next((t for s, t in topics.items() if name_key(query) in {name_key(x) for x in (s, t.extra.get("title", ""), t.extra.get("korean_query", "")) if x}), None):
        subject, english, pattern, basis = t.slug, t.extra.get("title"), t.pattern, "reviewed_topic"
    elif re.fullmatch(r"[A-Za-z][A-Za-z0-9 -]{1,119}", query.strip()):
        english, basis = query.strip(), "literal_english"
        pattern = rf"(?<![a-z0-9]){re.escape(english)}(?![a-z0-9])"
    _, *path = category.split("-")
    root = path[0] if path else ""
    known = len(path) == 1 and root in CATEGORIES  # a longer path is a constraint that nobody has reviewed
    status = "unmapped_category" if not known else "ready" if english else "unmapped_language"
    return Scope(query, category, subject, english, pattern, BOOK_KINDS.get(root), AUDIENCES.get(root), basis, status, CATEGORIES.get(root))


def literal_topic(query: str, category: str) -> Topic:
    """The topic of a search by its own words in one category of the bookstore; the slug is made of both."""
    words = unicodedata.normalize("NFKC", query).strip()
    path = category.split("-")
    if not 2 <= len(words) <= 120 or not any(map(str.isalnum, words)):
        raise ValueError("a query has 2 to 120 characters, and a letter or digit")
    if path[0] != ROOT or len(path) < 2 or not path[1].strip() or len(category) > 240:
        raise ValueError(f"not a category below {ROOT}")
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    pattern = r"\s*".join(map(re.escape, words.split()))
    pattern = rf"(?i)(?<![a-z0-9]){pattern}(?![a-z0-9])" if words.isascii() else pattern
    slug = "search-" + sha("".join(words.split()).lower() + "\0" + category)[:20]
    return Topic(slug, "provider-" + sha(path[1])[:16], pattern, category=f"^{re.escape(category)}$", discovery=True, extra={"title": words, "korean_query": words})


def is_browsing(topic: Topic, registry: dict[str, dict]) -> bool:
    """Whether a topic is a search, or exactly what the registry says of a field."""
    key = topic.slug.removeprefix("field-")
    return topic.slug.startswith("search-") or topic.slug.startswith("field-") and key in registry and field_topic(registry, key) == topic


def _phrase(text: str) -> str:
    return '"' + re.sub(r'([\\"])', r"\\\1", text) + '"'


def open_library_query(scope: Scope, fields: str, limit: int = MOST) -> dict:
    phrase = _phrase(scope.ready().english_query)
    asked = [ASKED[x] for x in (scope.book_kind, scope.audience) if x]
    return {"q": " AND ".join([f"(subject:{phrase} OR title:{phrase})", "language:eng", *asked]), "fields": f"{fields},subject", "limit": max(1, min(limit, MOST))}


def google_books_query(scope: Scope, limit: int = MOST) -> dict:
    return {"q": f"subject:{_phrase(scope.ready().english_query)}", "langRestrict": "en", "printType": "books", "maxResults": max(1, min(limit, MOST)), "startIndex": 0, "orderBy": "relevance"}


def candidate_limit(provider: str, wanted: int) -> int:
    """How many candidates to ask for: four times as many, but of Google Books just those."""
    return wanted if provider == "google_books" else 4 * wanted


def audit_response(responses: DataFrame, scope: Scope, topic: Topic, limit: int, provider: str, registry: dict[str, dict] | None = None):
    """The dataset of a scope's accepted candidates, and (response_id, pos, external_id, title, included, reason) of all.

    Candidates that the scope accepts and the normalizer or the limit drops are `normalization_or_limit`.
    """
    scope.ready()
    if not is_browsing(topic, registry or {}):
        raise ValueError("a discovery can't be a registered topic")
    data, settled = {"open_library": providers.open_library, "google_books": providers.google_books}[provider](responses, replace(topic, discovery=True), limit, scope=scope)
    included = F.col("reason").isNull()
    reason = F.when(included | ~accepted(F.col("decision")), F.col("decision")).otherwise("normalization_or_limit")
    return data, settled.select("response_id", "pos", "external_id", "title", included.alias("included"), reason.alias("reason"))
