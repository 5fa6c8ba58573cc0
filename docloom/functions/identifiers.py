"""Readers of identifiers: each finds the words that can only stand in identifiers of its kind, its anchors, and walks from there over the words
beside them. A text without anchors is left after one search; has_anchor(), in the JVM, keeps such texts
from being sent to Python at all.

A reader yields (start, end) of what stands in the text; what overlaps is settled by the caller.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import regex
from pyspark.sql import Column

from .patterns import COMPANY_MARKS, COURTS, DEFINING, MONTHS, NEUTRAL_COURTS, PARTY_LINKS, PROVISION_NAMES, REALMS, STATUTE_ENDS, STATUTE_LINKS, VOLUME_REPORTS, YEAR_REPORTS

Span = tuple[int, int]
Word = tuple[str, int, int]
#: Words on either side of an anchor that are looked at, and the characters that hold them.
PARTY_WORDS, STATUTE_WORDS, REACH = 8, 12, 600
_GLUE = "\\w\\-–.'’"


def _spaced(name: str) -> str:
    return r"\s+".join(regex.escape(w) for w in name.split())


def _either(names: list[str]) -> str:
    return "|".join(_spaced(n) for n in sorted(names, key=lambda n: (-len(n), n)))


def _words(pattern: regex.Pattern, text: str, low: int, high: int) -> list[Word]:
    return [(m.group(), m.start(), m.end()) for m in pattern.finditer(text, max(0, low), min(len(text), high))]


def _capital(word: str) -> bool:
    return "A" <= word[:1] <= "Z"


def _free(text: str, at: int) -> bool:
    """Nothing that belongs to a word stands before."""
    return at == 0 or not (text[at - 1].isalnum() or text[at - 1] in "_-–.'’")


# case names

_NAME_WORD = regex.compile(r"[\w'’.&\-]+|\S")
_VERSUS = regex.compile(r"(?<=\s)(?:vs\.?|versus|v\.?)(?=\s)|(?<![" + _GLUE + r"])(?:In\s+re|Ex\s+parte|Re)(?=\s)")
_PARTY_LINKS, _MARKS = frozenset(PARTY_LINKS), frozenset(m + stop for m in COMPANY_MARKS for stop in ("", "."))


def _party_after(text: str, at: int) -> int | None:
    """Where the party that begins after `at` ends."""
    words = _words(_NAME_WORD, text, at, at + REACH)
    if not words or not _capital(words[0][0]):
        return None
    n = next((i for i, (w, _, _) in enumerate(words[:PARTY_WORDS]) if not (_capital(w) or w in _PARTY_LINKS)), min(PARTY_WORDS, len(words)))
    end = words[n - 1][2]
    if n + 1 < len(words) and words[n][:2] == (",", end) and words[n + 1][1] > end + 1:
        mark = next((m for m in sorted(_MARKS, key=len, reverse=True) if words[n + 1][0].startswith(m)), None)
        if mark:
            return words[n + 1][1] + len(mark)
    return end


def _party_before(text: str, low: int, at: int) -> int | None:
    """Where the party that ends before `at` begins, the furthest place of all."""
    words = _words(_NAME_WORD, text, max(low, at - REACH), at)
    if len(words) > 2 and words[-1][0] in _MARKS and words[-2][0] == ",":
        words = words[:-2]
    best = None
    for w, start, _ in words[: -PARTY_WORDS - 1 : -1]:
        if _capital(w) and _free(text, start):
            best = start
        elif not _capital(w) and w not in _PARTY_LINKS:
            break
    return best


def case_names(text: str) -> Iterator[Span]:
    low = 0
    for anchor in _VERSUS.finditer(text):
        if anchor.start() < low:
            continue
        first = _party_before(text, low, anchor.start()) if anchor.group()[0] == "v" else anchor.start()
        end = _party_after(text, anchor.end()) if first is not None else None
        if end is not None:
            yield first, end
            low = end


# citations

_REPORTS = frozenset(VOLUME_REPORTS)
_VOLUME = regex.compile(r"(?<!\d)\d+\s+(?P<name>[A-Z][A-Za-z\d.\s]{0,16}?)\s+\d+(?!\d|(?:d|th)\b)")
_YEARLY = regex.compile(
    rf"\[\d{{4}}\]\s+(?:(?:{_either(NEUTRAL_COURTS)})\s+\d+(?:\s*\([A-Za-z]+\))?|\d+\s+S\.?C\.?R\.?\s+\d+|(?:\d+\s*)?(?:{_either(YEAR_REPORTS)})\s+\d+)"  # square: the year is the volume
    r"|\(\d{4}\)\s+\d+\s+[A-Z][A-Za-z.]{1,10}(?:\s+\(L&S\))?\s+\d+"  # round: it only tells the year
    r"|(?:AIR\s+\d{4}|\d{4}\s+SCC\s+OnLine)\s+[A-Z][A-Za-z.]*\s+\d+"
)


def citations(text: str) -> Iterator[Span]:
    for hit in _YEARLY.finditer(text):
        yield hit.span()
    for hit in _VOLUME.finditer(text, overlapped=True):  # a page may be the next citation's volume
        if "".join(c for c in hit["name"] if c not in ". \t\n\xa0") in _REPORTS:
            yield hit.span()


# provisions

_SIGN = regex.compile(r"§+\s*(?P<number>[\d.]+[A-Za-z]*(?:\([0-9a-zA-Z]+\))*)")
_CODE_BEFORE = regex.compile(r"(?:\d+\s+(?:U\.?S\.?C\.?|C\.?F\.?R\.?)|\b(?:[A-Z][a-z]{1,6}\.\s?){1,3}C\.|\b[A-Z]{2,6})\s+$")
_NUMBERED = regex.compile(rf"(?:{_either(PROVISION_NAMES)})\s*\d+[A-Z]{{0,3}}(?:[-–]\d*[A-Z]{{1,3}})?(?:\s*\([0-9a-zA-Z]{{1,4}}\))*")
_OTHERS = regex.compile(r"\d+\s+C\.?F\.?R\.?\s+[\d.]+|Order\s+[IVXLC]+\s+Rule\s+\d+[A-Z]*")


def provisions(text: str) -> Iterator[Span]:
    for hit in _NUMBERED.finditer(text):
        yield hit.span()
    for hit in _OTHERS.finditer(text):
        yield hit.span()
    for hit in _SIGN.finditer(text):  # the code's name stands before the sign
        code = _CODE_BEFORE.search(text, max(0, hit.start() - 40), hit.start())
        if code:
            yield code.start(), hit.end()


# statutes

_TITLE_WORD = regex.compile(r"\([A-Z]+\)|[\w'’\-]+|\S")
_ENDS, _TITLE_LINKS = frozenset(STATUTE_ENDS), frozenset(STATUTE_LINKS)
_END = regex.compile(rf"(?<![\w'’\-])(?:{_either(STATUTE_ENDS)})(?![\w'’\-])")
_YEAR = regex.compile(r",?\s+(?:of\s+)?\d{4}")
_PLACES = regex.compile(r"\s+of(?:\s+[A-Z][a-z]+)+")


def _titled(word: str) -> bool:
    return _capital(word) or word[:1] == "("  and len(word) > 2


def statutes(text: str) -> Iterator[Span]:
    low = 0
    for anchor in _END.finditer(text):
        if anchor.start() < low:
            continue
        first = None
        for w, start, _ in _words(_TITLE_WORD, text, max(low, anchor.start() - REACH), anchor.start())[: -STATUTE_WORDS : -1]:
            if _titled(w) and _free(text, start):
                first = start
            elif not _titled(w) and w not in _TITLE_LINKS:
                break
        if first is None:
            places = _PLACES.match(text, anchor.end()) if anchor.group() == "Constitution" else None
            if places:
                low = places.end()
                yield anchor.start(), low
            continue
        # as far as the run of words reaches, to its last ending word
        end = anchor.end()
        for n, (w, _, stop) in enumerate(_words(_TITLE_WORD, text, first, first + REACH)):
            if n > STATUTE_WORDS or (n and not _titled(w) and w not in _TITLE_LINKS):
                break
            if w in _ENDS and n:
                end = max(end, stop)
        year = _YEAR.match(text, end)
        low = year.end() if year else end
        yield first, low


# courts

_COURT = regex.compile(rf"\b(?:(?P<name>{_either(COURTS)})(?!\w)|\d+(?:st|nd|rd|th)\s+Cir\.)")
_PLACE = regex.compile(rf"\s+of\s+(?:{_either(REALMS)}|[A-Z][a-z]+)")
_PLACE_NAMES = regex.compile(r"\s+of\s+[A-Z][a-z]+(?:\s+(?:and\s+)?[A-Z][a-z]+)*")
_CIRCUIT = regex.compile(r"\s+for\s+the\s+[\w\s]+?\s+Circuit")
_STATE = regex.compile(r"\b[A-Z][a-z]+\s+$")
#: What may follow a court's name.
_TAILS = {"Supreme Court": _PLACE, "High Court": _PLACE_NAMES, "Court of Appeal": _CIRCUIT, "Court of Appeals": _CIRCUIT}


def courts(text: str) -> Iterator[Span]:
    for hit in _COURT.finditer(text):
        start, end, name = hit.start(), hit.end(), " ".join((hit["name"] or "").split())
        tail = _TAILS[name].match(text, end) if name in _TAILS else None
        if name == "High Court":
            state = _STATE.search(text, max(0, start - 40), start)
            start = state.start() if state else start
        yield start, tail.end() if tail else end


# dates

_MONTH = regex.compile(rf"(?<![^\W\d])(?:{_either(MONTHS)})(?!\w)")
_DAY_BEFORE = regex.compile(r"\b\d{1,2}(?:st|nd|rd|th)?\s+$")
_YEAR_AFTER = regex.compile(r"\.?,?\s+\d{4}")
_DAY_AND_YEAR = regex.compile(r"\.?\s+\d{1,2},\s+\d{4}")
_FIGURES = regex.compile(r"\b\d{1,2}[./-]\d{1,2}[./-]\d{4}\b")


def dates(text: str) -> Iterator[Span]:
    for month in _MONTH.finditer(text):
        day = _DAY_BEFORE.search(text, max(0, month.start() - 8), month.start())
        year = _YEAR_AFTER.match(text, month.end()) if day else None
        after = None if year else _DAY_AND_YEAR.match(text, month.end())
        if year:
            yield day.start(), year.end()
        elif after:
            yield month.start(), after.end()
    for hit in _FIGURES.finditer(text):
        yield hit.span()


# defined terms

_DEFINED = regex.compile(r"[\"“‘'](?P<term>[^\"”’'\n]{2,60})[\"”’']\s*(?=" + _either(DEFINING) + ")")


def defined_terms(text: str) -> Iterator[Span]:
    for hit in _DEFINED.finditer(text):
        yield hit.span("term")


#: By precedence where two identifiers have the same place and length.
READERS = {"citation": citations, "provision": provisions, "case_name": case_names, "court": courts, "statute": statutes, "date": dates, "defined_term": defined_terms}

#: Java patterns: a text in which none finds anything has no identifier. The first is looked for in texts with a figure only.
FIGURES = "|".join(
    [
        r"\d\s+[A-Z]|\d\]\s+[A-Z\d]|AIR\s+\d",
        r"(?:ections?|ecs?\.?|[Ss]\.|ss\.|§|rticles?|rts?\.|ules?|egulations?|egs?\.|lauses?|aragraph|ara\.?|chedule)\s*\d",
        r"(?:" + "|".join(MONTHS) + r")\.?,?\s+\d|\d[./-]\d{1,2}[./-]\d{4}",
    ]
)
PAIRS = r"\sv(?:s\.?|ersus|\.)?\s|(?:In\s+re|Ex\s+parte|Re)\s"
QUOTED = r"[\"”’']\s*(?:" + "|".join(d.replace(" ", r"\s+") for d in DEFINING) + ")"
NAMES = [*STATUTE_ENDS, "Court", "Tribunal", "Lords", "Council", "Cir."]


def has_anchor(text: Column) -> Column:
    """False only where a text has no identifier."""
    named = reduce(lambda a, b: a | b, [text.contains(n) for n in NAMES])
    return named | text.rlike(PAIRS) | text.rlike(QUOTED) | (text.rlike("[0-9]") & text.rlike(FIGURES))
