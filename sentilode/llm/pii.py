"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over the text: at-signs, plus signs, digits,
schemes and cue words. A local parser per anchor expands to the left and right, finds the
boundaries and validates what it has found. All parsers are deterministic and linear.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sentilode.llm.common import slices, spread_texts

# Kinds in the order of the contract, then those that the anchors add.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("url", "handle", "iban", "ssn", "account", "secret")
KINDS = BASE_KINDS + ADDED_KINDS
# Cue words, and the kind of what follows them.
CUES = {
    "iban": "iban",
    "ssn": "ssn",
    "social security": "ssn",
    "account": "account",
    "acct": "account",
    "passport": "account",
    "customer id": "account",
    "password": "secret",
    "passwd": "secret",
    "api_key": "secret",
    "apikey": "secret",
    "access_token": "secret",
    "secret_key": "secret",
}
SCHEMA = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    "base_sha256 string, spans string"
)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGITS = re.compile(r"[0-9]++")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HANDLE = re.compile(r"[A-Za-z0-9_]{2,30}+(?![A-Za-z0-9_.-]*@)")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{0,30}\Z")
_URL_REST = re.compile(r"[^\x00-\x20<>\"'`{}|\\^]+")
_AFTER_CUE = re.compile(r"(?:\s?(?:number|nr|no|id)\b\.?)?[\s:=#]{1,3}", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_ACCOUNT = re.compile(r"[A-Za-z0-9](?:[-]?[A-Za-z0-9]){5,33}")
_SECRET = re.compile(r"[A-Za-z0-9_+/.-]{8,128}=*")

_AT, _PLUS, _DIGIT, _SLASHES, _WWW, _CUE = range(6)
_machine = None


def automaton():
    """The automaton of all anchors; built once per worker."""
    global _machine
    if _machine is None:
        import ahocorasick

        machine = ahocorasick.Automaton()
        machine.add_word("@", (_AT, 1, ""))
        machine.add_word("+", (_PLUS, 1, ""))
        for digit in "0123456789":
            machine.add_word(digit, (_DIGIT, 1, ""))
        machine.add_word("://", (_SLASHES, 3, ""))
        for www in ("www.", "WWW."):
            machine.add_word(www, (_WWW, 4, ""))
        for cue, kind in CUES.items():
            for form in {cue, cue.upper(), cue.title(), cue.capitalize()}:
                machine.add_word(form, (_CUE, len(form), kind))
        machine.make_automaton()
        _machine = machine
    return _machine


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def iban_ok(value: str) -> bool:
    """Remainder 1 modulo 97, with letters as two digits and the first four places last."""
    plain = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _parts_ok(ip: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in ip.split(".")))


def _trim_url(text: str, start: int, end: int) -> int:
    while end > start and text[end - 1] in ".,;:!?)]":
        end -= 1
    return end


def find(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all spans, sorted; kind indexes KINDS, places are code points."""
    found: list[tuple[int, int, int]] = []
    email_from = ip_from = card_from = url_from = 0
    for last, (anchor, length, cue) in automaton().iter(text):
        if anchor == _DIGIT:
            if last >= ip_from:
                match = _IP.match(text, last)
                if match:
                    ip_from = match.end()
                    if _parts_ok(match.group()):
                        found.append((1, last, ip_from))
                else:
                    ip_from = _DIGITS.match(text, last).end()
            if last >= card_from:
                match = _CARD.match(text, last)
                card_from = match.end() if match else last + 1
                if match and card_from - last >= 16:
                    digits = match.group().replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        found.append((2, last, card_from))
        elif anchor == _AT:
            start = last
            while start > email_from and text[start - 1] in _LOCAL:
                start -= 1
            match = _DOMAIN.match(text, last + 1) if start < last else None
            if match:
                email_from = match.end()
                found.append((0, start, email_from))
            elif last == 0 or not (text[last - 1].isalnum() or text[last - 1] in "._%+-@"):
                match = _HANDLE.match(text, last + 1)
                if match:
                    found.append((5, last, match.end()))
        elif anchor == _PLUS:
            match = _PHONE.match(text, last)
            if match and 8 <= sum(c in "0123456789" for c in match.group()) <= 15:
                found.append((3, last, match.end()))
        elif anchor in (_SLASHES, _WWW):
            first = last - length + 1
            if first < url_from:
                continue
            if anchor == _SLASHES:
                scheme = _SCHEME.search(text[max(url_from, first - 31):first])
                if not scheme:
                    continue
                start = first - len(scheme.group())
            elif first and text[first - 1].isalnum():
                continue
            else:
                start = first
            match = _URL_REST.match(text, last + 1)
            end = _trim_url(text, last + 1, match.end()) if match else last + 1
            if end > last + 1:
                url_from = end
                found.append((4, start, end))
        else:
            gap = _AFTER_CUE.match(text, last + 1)
            if not gap:
                continue
            found.extend(_after_cue(text, gap.end(), cue))
    return sorted(set(found))


def _after_cue(text: str, at: int, cue: str) -> list[tuple[int, int, int]]:
    """The identifier that begins at `at`, if it is one of the kind that the cue names."""
    if cue == "iban":
        match = _IBAN.match(text, at)
        while match and not iban_ok(match.group()):
            shorter = match.end() - 1
            match = _IBAN.match(text, at, shorter) if shorter - at >= 15 else None
        return [(KINDS.index("iban"), at, match.end())] if match else []
    if cue == "ssn":
        match = _SSN.match(text, at)
        return [(KINDS.index("ssn"), at, match.end())] if match else []
    match = (_SECRET if cue == "secret" else _ACCOUNT).match(text, at)
    if match and any(c in "0123456789" for c in match.group()):
        return [(KINDS.index(cue), at, match.end())]
    return []


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        counts: list[list[int]] = [[], [], [], []]
        shas, joined = [], []
        for text in batch.column(1).to_pylist():
            spans = find(text)
            base = [s for s in spans if s[0] < len(BASE_KINDS)]
            for kind in range(len(BASE_KINDS)):
                counts[kind].append(sum(s[0] == kind for s in base))
            shas.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            joined.append(_joined(spans))
        longs = [pa.array(c, pa.int64()) for c in counts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *longs, pa.array(shas, pa.string()), pa.array(joined, pa.string())],
            ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
        )


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts per base kind, their digest, and all spans.

    Texts are read whole. A null or empty text has no spans; a null id is kept; repeated rows give
    repeated rows; an empty table gives an empty one. Columns other than the two named are ignored,
    so their names cannot clash. Of spans of one kind none overlap; spans of different kinds may.
    Nothing is shuffled.
    """
    return spread_texts(docs, id_col, text_col).mapInArrow(_scan, SCHEMA)


def mask(text: str, spans: str) -> str:
    """`text` with each span replaced by its kind in angle brackets; of overlapping ones the first."""
    out, at = [], 0
    for start, end, kind in sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s)):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
            at = end
    return "".join(out) + text[at:]
