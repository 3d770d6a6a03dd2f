"""Personal data found by anchors: what marks a place first, what stands round it afterwards.

One Aho-Corasick pass over a text finds at-signs, plus signs, digits side by side or a dot,
space or hyphen apart, address schemes and words that announce an identifier. At each anchor
a parser of its kind expands to both sides as far as the kind's boundaries go, and checks
what it has found. Each parser remembers how far it has read, so a text is read a constant
number of times.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.session import ship_package

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_CALL = re.compile(r"\+[0-9]([\x20().0-9-]+)")
_HOST = r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*|\[[0-9A-Fa-f:.]+\])"
_AUTHORITY = re.compile(rf"[A-Za-z0-9._~!$&'()*+,;=%:-]+@{_HOST}(?::([0-9]+))?")
_MAILBOX = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIAL = re.compile(r"\+?[0-9](?:[().-]*[0-9])+")
_LINK = re.compile(r"(?:[ \t]*(?:number|no\.?|num\.?|id|code|key|#))?[ \t]*([:=#]?)[ \t]*[\"']?", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SOCIAL = re.compile(r"([0-9]{3})[ -]?([0-9]{2})[ -]?([0-9]{4})")
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])+")
_DOCUMENT = re.compile(r"[A-Z]{0,2}[0-9]+")
_SECRET = re.compile(r"[A-Za-z0-9_./+=-]+")

# Words that announce an identifier, by the parser that reads it.
_CUES = {
    "iban": ("iban",),
    "social": ("ssn", "social security"),
    "number": ("account", "acct", "a/c", "routing", "customer", "member"),
    "document": ("passport", "tax id", "national id"),
    "secret": ("token", "api_key", "apikey", "api key", "secret", "password"),
}


class Span(NamedTuple):
    kind: str
    start: int
    end: int


@lru_cache(maxsize=1)
def _anchors():
    """The automaton: anchor -> (parser, length)."""
    from ahocorasick import Automaton

    out = Automaton()

    def add(word: str, parser: str) -> None:
        out.add_word(word, (parser, len(word)))

    add("@", "email")
    add("+", "phone")
    add("://", "scheme")
    for first in "0123456789":
        for second in "0123456789":
            add(f"{first}.{second}", "chain")
            for between in ("", " ", "-"):
                add(f"{first}{between}{second}", "run")
    for word in ("mailto:", "sip:", "xmpp:"):
        for form in {word, word.capitalize(), word.upper()}:
            add(form, "mailbox")
    for form in ("tel:", "Tel:", "TEL:"):
        add(form, "dial")
    for parser, words in _CUES.items():
        for word in words:
            for form in {word, word.capitalize(), word.title(), word.upper()}:
                add(form, parser)
    out.make_automaton()
    return out


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _at_most_255(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def _iban_end(text: str, start: int) -> int | None:
    """The end of the longest account number there whose check number is right."""
    m = _IBAN.match(text, start)
    end = m.end() if m else 0
    while m and end > start:
        plain = text[start:end].replace(" ", "")
        if len(plain) < 15:
            return None
        if not text[end : end + 1].isalnum() and text[end - 1] != " ":
            number = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
            if int(number) % 97 == 1:
                return end
        end -= 1
    return None


class _Reader:
    """One text's parsers; ``done`` is how far each kind has been read."""

    def __init__(self, text: str):
        self.text = text
        self.done = dict.fromkeys(KINDS, 0)
        self.found: dict[str, list[Span]] = {k: [] for k in KINDS}

    def add(self, kind: str, start: int, end: int) -> None:
        self.found[kind].append(Span(kind, start, end))
        self.done[kind] = end

    def email(self, lo: int, hi: int) -> None:
        start, floor, text = lo, self.done["email"], self.text
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < lo and (m := _DOMAIN.match(text, hi)):
            self.add("email", start, m.end())

    def chain(self, lo: int, hi: int) -> None:
        if lo < self.done["ip"]:
            return
        start, floor, text = lo, self.done["ip"], self.text
        while start > floor and "0" <= text[start - 1] <= "9":
            start -= 1
        m = _CHAIN.match(text, start)
        parts = m[0].split(".")
        at = start
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(map(_at_most_255, four)):
                self.add("ip", at, end)
            at = end + 1
        self.done["ip"] = m.end()

    def run(self, lo: int, hi: int) -> None:
        # The first pair of a run is found first, so the run begins with it.
        if lo >= self.done["card"]:
            m = _RUN.match(self.text, lo)
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                self.add("card", lo, m.end())
            self.done["card"] = m.end()

    def phone(self, lo: int, hi: int) -> None:
        m = _CALL.match(self.text, lo)
        if m:
            # The last digit ends the number; one sign at least stands between it and the first.
            body = m[1].rstrip(" ().-")
            if len(body) > 1 and 8 <= len(_digits(body)) + 1 <= 15:
                self.add("phone", lo, lo + 2 + len(body))

    def scheme(self, lo: int, hi: int) -> None:
        """scheme://user[:password]@host[:port]; without a user it names no one."""
        start, floor, text = lo, self.done["address"], self.text
        while start > floor and text[start - 1] in _SCHEME:
            start -= 1
        while start < lo and not text[start].isalpha():
            start += 1
        m = _AUTHORITY.match(text, hi)
        if start < lo and m and (m[1] is None or (len(m[1]) <= 5 and int(m[1]) <= 65535)):
            self.add("address", start, m.end())

    def mailbox(self, lo: int, hi: int) -> None:
        m = _MAILBOX.match(self.text, hi)
        if m and self._word_start(lo) and lo >= self.done["address"]:
            self.add("address", lo, m.end())

    def dial(self, lo: int, hi: int) -> None:
        m = _DIAL.match(self.text, hi)
        if m and self._word_start(lo) and 8 <= len(_digits(m[0])) <= 15 and lo >= self.done["address"]:
            self.add("address", lo, m.end())

    def _word_start(self, at: int) -> bool:
        return at == 0 or not (self.text[at - 1].isalnum() or self.text[at - 1] == "_")

    def _value(self, lo: int, hi: int) -> tuple[int, bool] | None:
        """Where what a cue announces begins, and whether a sign says that it does."""
        if lo < self.done["account"] or not self._word_start(lo) or self.text[hi : hi + 1].isalnum():
            return None
        m = _LINK.match(self.text, hi)
        return m.end(), bool(m[1])

    def _ends(self, at: int) -> bool:
        return not (self.text[at : at + 1].isalnum() or self.text[at : at + 1] == "_")

    def iban(self, lo: int, hi: int) -> None:
        if (at := self._value(lo, hi)) and (end := _iban_end(self.text, at[0])):
            self.add("account", at[0], end)

    def social(self, lo: int, hi: int) -> None:
        if at := self._value(lo, hi):
            m = _SOCIAL.match(self.text, at[0])
            if m and self._ends(m.end()) and m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00":
                self.add("account", at[0], m.end())

    def number(self, lo: int, hi: int) -> None:
        if at := self._value(lo, hi):
            m = _NUMBER.match(self.text, at[0])
            if m and self._ends(m.end()) and 6 <= len(_digits(m[0])) <= 17:
                self.add("account", at[0], m.end())
            elif not m:
                self.iban(lo, hi)

    def document(self, lo: int, hi: int) -> None:
        if at := self._value(lo, hi):
            m = _DOCUMENT.match(self.text, at[0])
            if m and self._ends(m.end()) and 7 <= len(m[0]) <= 12:
                self.add("account", at[0], m.end())

    def secret(self, lo: int, hi: int) -> None:
        if (at := self._value(lo, hi)) and at[1]:
            m = _SECRET.match(self.text, at[0])
            if m and len(m[0]) >= 8 and any(map(str.isdigit, m[0])) and any(map(str.isalpha, m[0])):
                self.add("account", at[0], m.end())


def find(text: str | None) -> list[Span]:
    """All spans of a text in code points, by kind as in KINDS, then by start. Null is empty.

    email, ip, card and phone are the leftmost matches of their patterns that do not overlap,
    less those that fail their check. address is what follows a scheme and names a user, a
    mailbox or a number; account is an identifier that a word announces. Kinds may overlap.
    """
    if not text:
        return []
    reader = _Reader(text)
    for last, (parser, length) in _anchors().iter(text):
        getattr(reader, parser)(last + 1 - length, last + 1)
    return [s for k in KINDS for s in reader.found[k]]


def masked(text: str, spans: list[Span]) -> str:
    """The text with every stretch that spans cover replaced by its first span's kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s.start, -s.end)):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def detect(docs: DataFrame, *, mask: bool = False) -> DataFrame:
    """(doc_id, spans): one row per row of ``docs`` (doc_id, text), repeated ones as well.

    ``spans`` are structs of kind, start and end (exclusive), in code points, as ``find``
    gives them; empty for a null or empty text. With ``mask`` a column ``text`` has the text
    with them replaced. A null doc_id stays null; other columns are not read.
    """
    ship_package(docs.sparkSession)
    schema = "doc_id long, spans array<struct<kind string, start long, end long>>" + ", text string" * mask
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            spans = [find(t) for t in texts]
            columns = [batch.column(0), pa.array([[s._asdict() for s in own] for own in spans], kind)]
            if mask:
                columns.append(pa.array([masked(t or "", s) for t, s in zip(texts, spans, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "spans", "text"][: len(columns)])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def report(found: DataFrame) -> DataFrame:
    """Counts, digest and listing of the spans of ``detect``."""

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(joined(of(*BASE)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
