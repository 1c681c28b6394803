"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

Four base kinds follow fixed patterns and stay whatever their score. Two more
kinds need more than a pattern: ``iban`` must have its country's length and
pass mod-97, ``national_id`` has no checksum, must be in an issued range and
must have a context word nearby, and no word of doubt.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, functions as F

from salesmart.llm.common import scan

# The patterns of the base kinds, and what else each must satisfy.
BASE_KINDS = ("email", "ip", "card", "phone")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# The added kinds.
ADDED_KINDS = ("iban", "national_id")
# Characters of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20}
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}(?=[\x20-]?[A-Za-z0-9])")
NATIONAL_ID = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
# Words that make a kind likelier when near, and scores before and after.
CONTEXT_WORDS = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "national_id": ("ssn", "social", "security", "id", "identity", "passport"),
}
# Words that make a kind less likely when near: numbers and names of another sort.
DOUBT_WORDS = {
    "email": ("example", "sample", "dummy"),
    "ip": ("version", "release", "build", "section", "chapter", "firmware"),
    "card": ("tracking", "serial", "isbn", "barcode", "parcel"),
    "phone": ("tracking", "serial", "invoice", "version", "score"),
    "iban": ("example", "sample", "dummy"),
    "national_id": ("tracking", "serial", "invoice", "order", "part", "model"),
}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "national_id": 0.4}
CONTEXT_GAIN, DOUBT_LOSS, CONTEXT_CHARS, KEEP_AT = 0.15, 0.2, 40, 0.5
WORD = re.compile(r"[^\W\d_]+")

SCHEMA = ("doc_id long, kinds array<string>, starts array<int>, ends array<int>, scores array<double>, "
          "base array<boolean>")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit)
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def mod97(code: str) -> bool:
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def iban_at(text: str, start: int) -> int | None:
    """End of the IBAN that starts at ``start``: its country's number of letters and digits, in one run or in
    groups parted by single blanks or hyphens, as a whole word and with a checksum that holds. Case is free."""
    left = IBAN_LENGTHS.get(text[start:start + 2].upper())
    if left is None:
        return None
    code, at = [], start
    while left and at < len(text):
        c = text[at]
        if c.isascii() and c.isalnum():
            code.append(c)
            left -= 1
        elif c not in " -" or text[at - 1] in " -":
            return None
        at += 1
    if left or text[at:at + 1].isascii() and text[at:at + 1].isalnum():
        return None
    return at if mod97("".join(code).upper()) else None


def ibans(text: str) -> list[tuple[int, int]]:
    """Spans of IBANs; behind a start that is none the search goes on at the next character."""
    found, at = [], 0
    while m := IBAN_START.search(text, at):
        end = iban_at(text, m.start())
        if end:
            found.append((m.start(), end))
        at = end or m.start() + 1
    return found


def emails(text: str) -> list[tuple[int, int]]:
    """Each domain with the run of local characters before its ``@``; linear also where no ``@`` follows a run."""
    found, free = [], 0
    for domain in EMAIL_DOMAIN.finditer(text):
        at = start = domain.start()
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        if start < at:
            found.append((start, domain.end()))
            free = domain.end()
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base kinds in the order of ``BASE_KINDS``, each by start."""
    spans = [("email", *span) for span in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) < 4 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


def scored(text: str, kind: str, start: int, end: int) -> float:
    """The prior of the kind, raised for a context word and lowered for a word of doubt within ``CONTEXT_CHARS``; 0 to 1."""
    near = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]
    words = {w.lower() for w in WORD.findall(near)}
    score = PRIOR[kind] + CONTEXT_GAIN * (not words.isdisjoint(CONTEXT_WORDS[kind]))
    return round(max(0.0, min(1.0, score - DOUBT_LOSS * (not words.isdisjoint(DOUBT_WORDS[kind])))), 4)


def find_spans(text: str | None) -> list[tuple[str, int, int, float, bool]]:
    """All spans of a text as (kind, start, end, score, base), by kind as listed, then start; null has none."""
    if not text:
        return []
    found = [(k, s, e, scored(text, k, s, e), True) for k, s, e in base_spans(text)]
    for start, end in ibans(text):
        found.append(("iban", start, end, scored(text, "iban", start, end), False))
    for m in NATIONAL_ID.finditer(text):
        score = scored(text, "national_id", m.start(), m.end())
        if score >= KEEP_AT:
            found.append(("national_id", m.start(), m.end(), score, False))
    return found


def _scan(columns: dict[str, list]) -> dict[str, list]:
    spans = [find_spans(text) for text in columns["text"]]
    parts = {name: [[s[i] for s in found] for found in spans]
             for i, name in enumerate(("kinds", "starts", "ends", "scores", "base"))}
    return {"doc_id": columns["doc_id"], **parts}


def find_pii(docs: DataFrame) -> DataFrame:
    """Spans of every row: doc_id and parallel arrays kinds, starts, ends, scores, base.

    Positions count code points, the end is exclusive. One row in, one row out:
    null and empty texts give empty arrays, repeated rows repeat, a null doc_id
    stays null, an empty table gives none. Only doc_id and text are read.
    """
    return scan(docs.select("doc_id", "text"), _scan, SCHEMA)


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each span replaced by its kind in brackets; overlapping spans are merged under the first kind."""
    if text is None:
        return None
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact_pii(docs: DataFrame) -> DataFrame:
    """doc_id and the text with all its spans masked."""
    return scan(docs.select("doc_id", "text"),
                lambda c: {"doc_id": c["doc_id"],
                           "text": [redact(t, [s[:3] for s in find_spans(t)]) for t in c["text"]]},
                "doc_id long, text string")


def span_digests(found: DataFrame, counted: dict[str, str]) -> DataFrame:
    """doc_id, a count per kind, base_sha256 and spans from a frame of span arrays in their listed order."""
    spans = F.arrays_zip("kinds", "starts", "ends", "base")
    said = lambda s: F.concat_ws(":", s["kinds"], s["starts"], s["ends"])
    of_kind = lambda kind: F.size(F.filter("kinds", lambda k: k == kind)).cast("long")
    counts = [of_kind(kind).alias(name) for kind, name in counted.items()]
    base = F.concat_ws(",", F.transform(F.filter(spans, lambda s: s["base"]), said))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"),
                        F.concat_ws(",", F.transform(spans, said)).alias("spans"),
                        F.concat_ws(",", F.transform("scores", lambda x: x.cast("string"))).alias("scores"))


def sha256_of(spans: list[tuple[str, int, int]]) -> str:
    """Driver-side twin of base_sha256, for tests."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
