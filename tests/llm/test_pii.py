"""Spans against plain regular expressions, and the edge cases."""

from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from sentilode.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [("phone", m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]
    return [f"{k}:{a}:{b}" for k, (a, b) in out]


def base(text):
    return [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.find(text) if k < 4]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab@@..+-12345  ()é_%\n", max_size=60))
def test_base_spans_of_any_text(text):
    assert base(text) == brute(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "4111-1111", "1.2.3.4", "256.1.1.1", "a.b@c.de", "@", ".", "+1 (743) 555-3824", " ", "x", "é", "0000001.2.3.4", "5500005555555559"]), max_size=8).map("".join))
def test_base_spans_of_pieces(text):
    assert base(text) == brute(text)


def test_added_kinds():
    text = "See https://user.example.org/a?b=1, IBAN: GB82 WEST 1234 5698 7654 32; ssn 123-45-6789 account no. AB-123456 password=da3fe1beadc3 by @some_one"
    found = {pii.KINDS[k]: text[a:b] for k, a, b in pii.find(text)}
    assert found["url"] == "https://user.example.org/a?b=1"
    assert found["iban"].replace(" ", "") == "GB82WEST12345698765432"
    assert found["ssn"] == "123-45-6789"
    assert found["account"] == "AB-123456"
    assert found["secret"] == "da3fe1beadc3"
    assert found["handle"] == "@some_one"
    assert not pii.find("Clean prose, with 3 numbers: 12, 1999 and 7.")


def test_long_texts_are_linear():
    for text in ("1" * 300_000, "a." * 150_000 + "@", "+" * 300_000, "1 " * 150_000, "1.2.3." * 50_000, "@" * 300_000, "www." * 75_000):
        pii.find(text)


def test_operator(spark, make_docs):
    rows = [(1, "mail a@b.co"), (1, "mail a@b.co"), (2, None), (3, ""), (None, "+1 (743) 555-3824"), (5, "é 😀 10.0.0.1 " + "w " * 100_000)]
    found = pii.find_personal_data(make_docs(rows)).collect()
    assert len(found) == 6
    by = {r.doc_id: r for r in found}
    assert by[1].spans == "email:5:11" and by[1].n_email == 1
    assert by[2].spans == "" and by[2].base_sha256 == hashlib.sha256(b"").hexdigest() == by[3].base_sha256
    assert by[None].n_phone == 1
    assert by[5].spans == "ip:4:12"
    assert pii.find_personal_data(make_docs([(1, "x")]).limit(0)).collect() == []
    assert pii.mask("mail a@b.co", by[1].spans) == "mail <email>"
