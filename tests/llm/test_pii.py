import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chartloom.llm import pii


def brute(text):
    """The base kinds by their patterns alone."""
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19:
            total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, digits[::-1])))
            if total % 10 == 0:
                out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.findall("[0-9]", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def base(text):
    return [tuple(s) for s in pii.find(text) if s.kind in pii.BASE]


def test_base_spans_equal_the_patterns_on_random_texts():
    r = random.Random(6)
    alphabets = ["a@.b1-_+% ", "0123456789 -", "0123456789.", "+12 ().-a", "ab@.:/1 é+=\n", "4 1-.+@x0"]
    for alphabet in alphabets:
        for _ in range(4000):
            text = "".join(r.choices(alphabet, k=r.randrange(40)))
            assert base(text) == brute(text), text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["a@b.c", "@", ".", "4111 1111 1111 1111", "4111111111111111", "1.2.3.4", "256.1.1.1", "+1 (017) 555-7713", "+", "-",
     " ", "7", "é", "x", "iban ", "token = \"", "ssn: ", "ftp://", "mailto:", "account no. ", "5" * 30]), max_size=14))
def test_base_spans_equal_the_patterns_on_joined_pieces(pieces):
    text = "".join(pieces)
    assert base(text) == brute(text)


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("see ftp://joe:pw@files.example.org:21/x.", "address", "ftp://joe:pw@files.example.org:21"),
        ("see https://example.org/a@b", "address", None),
        ("http://joe@example.org:99999", "address", None),
        ("Mailto:joe@example.org.", "address", "Mailto:joe@example.org"),
        ("(tel:+1-555-010-9999)", "address", "tel:+1-555-010-9999"),
        ("hotel:5550109999", "address", None),
        ("IBAN GB82 WEST 1234 5698 7654 32 was", "account", "GB82 WEST 1234 5698 7654 32"),
        ("IBAN GB82 WEST 1234 5698 7654 33 was", "account", None),
        ("SSN: 123-45-6789", "account", "123-45-6789"),
        ("SSN: 000-45-6789", "account", None),
        ("Account number 0012 3456 78, paid", "account", "0012 3456 78"),
        ("account of 12345678", "account", None),
        ("subaccount 12345678", "account", None),
        ("passport: AB123456", "account", "AB123456"),
        ('token = "908038b7daaf91e7"', "account", "908038b7daaf91e7"),
        ("a token of 908038b7daaf91e7", "account", None),
        ("tokens = 908038b7daaf91e7", "account", None),
    ],
)
def test_added_kinds_end_at_their_boundaries(text, kind, found):
    spans = [text[s.start : s.end] for s in pii.find(text) if s.kind == kind]
    assert spans == ([found] if found else [])


def test_report_masks_and_odd_rows(spark, documents, rows):
    text = "é joe@example.org, 10.0.0.1 and +1 (017) 555-7713; token = \"908038b7daaf91e7\""
    docs = [(1, text), (1, text), (2, None), (3, ""), (None, "4111 1111 1111 1111"), (4, "1" * 200_000 + " a@b.c")]
    table = documents(docs)
    got = rows(pii.report(pii.detect(table)))
    want = []
    for i, t in docs:
        found = brute(t)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()
        counts = [sum(k == kind for k, _, _ in found) for kind in pii.BASE]
        spans = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in pii.find(t))
        want.append((i, *counts, digest, spans))
    assert got == sorted(want, key=str)
    clean = {r.doc_id: r.text for r in pii.detect(table, mask=True).collect()}
    assert clean[1] == '[email], [ip] and [phone]; token = "[account]"'.join(["é ", ""])
    assert clean[2] == "" and clean[None] == "[card]"
    assert rows(pii.detect(documents([]))) == []
