"""Ordered decisions over metadata: relevance, scope, script routing, supplements. One CASE chain each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEVER = "(?!)"


def relevance(subjects: Column, title: Column, pattern: str, conflict: str | None = None) -> Column:
    """Subjects decide first (a conflict before a match); without their word the title may, unverified."""
    s, t = F.coalesce(subjects, F.lit("")), F.coalesce(title, F.lit(""))
    out = F.when((s != "") & s.rlike(f"(?i){conflict}"), "conflicting_subject") if conflict else F.when(F.lit(False), "")
    return out.when((s != "") & s.rlike(f"(?i){pattern}"), "matching_subject").when(t.rlike(f"(?i){pattern}"), "title_only_unverified").otherwise("no_topic_evidence")


def accepted(reason: Column) -> Column:
    return reason.isin("matching_subject", "title_only_unverified")


def scope_decision(title: Column, subjects: Column, english: Column, has_isbn: Column, evidence: str, category: str | None = None, book_kind: str | None = None, audience: str | None = None) -> Column:
    """The first reason that holds, in the order of the checks."""
    hit = lambda c, p: c.rlike(f"(?i){p}")
    reason = F.when(hit(subjects, evidence), "matching_subject").when(hit(title, evidence), "title_only_unverified").otherwise("no_subject_evidence")
    include = hit(subjects, evidence) | hit(title, evidence)
    young = hit(subjects, "juvenile|children|young adult")
    out = F.when(~english, "no_english_edition").when(~has_isbn, "missing_valid_isbn")
    if category:
        out = out.when(include & ~hit(subjects, category), "category_subject_unconfirmed")
    if book_kind == "textbook":
        out = out.when(include & ~hit(subjects, "textbooks?"), "book_kind_unconfirmed")
    if audience in ("children", "teen"):
        out = out.when(include & ~hit(subjects, "juvenile|children" if audience == "children" else "young adult"), "audience_unconfirmed")
    elif audience is None:
        out = out.when(include & young, "conflicting_audience")
    return out.when(include & hit(subjects, r"\bfiction\b|\bexaminations\b|\bstudy guides\b"), "conflicting_book_kind").otherwise(reason)


def copy_if_script(target: Column, text: Column, language: Column, languages: list[str], foreign: str) -> Column:
    """The target, or else the text itself where its language is one of these and it has no letter of a foreign script."""
    return F.coalesce(target, F.when(language.isin(languages) & ~text.rlike(foreign), text))


def is_supplement(normalized: Column, markers: tuple[str, ...]) -> Column:
    """Whether a marker stands in the text, also when all spaces are gone."""
    squeezed = F.replace(normalized, F.lit(" "), F.lit(""))
    out = F.lit(False)
    for m in markers:
        out = out | F.contains(normalized, F.lit(m)) | F.contains(squeezed, F.lit(m.replace(" ", "")))
    return out


def usable_outline(titles: Column, least: int = 3) -> Column:
    """At least so many entries, and as many distinct ones."""
    return (F.size(titles) >= least) & (F.size(F.array_distinct(F.transform(titles, lambda x: F.lower(F.trim(x))))) >= least)
