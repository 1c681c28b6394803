"""Secrets: an Aho-Corasick pass finds keywords, anchored patterns run only at hits, checksums confirm.

The base kinds follow fixed patterns. ``github`` and ``npm`` tokens carry a
CRC-32 of their body in base 62 and are kept only when it agrees;
``private_key`` blocks need both of their marker lines, with headers or
without; a ``jwt`` must have a JSON head that names an algorithm and a JSON
body.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib

import ahocorasick
from pyspark.sql import DataFrame

from salesmart.llm.common import scan
from salesmart.llm.pii import SCHEMA

# The patterns of the base kinds and the least lengths.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
# The added kinds.
ADDED_KINDS = ("github", "private_key", "npm", "jwt")
GITHUB_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+(?![A-Za-z0-9_-])")
KEY_MARK = "-----begin "
# line ends may be written out as \n, as in JSON; headers are lines such as "Proc-Type: 4,ENCRYPTED"
PRIVATE_KEY = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY(?: BLOCK)?)-----(?:(?:\r?\n|(?:\\r)?\\n)+[A-Z][A-Za-z-]+: (?:(?!-----)[^\r\n\\])*)*+"
                         r"(?:[A-Za-z0-9+/=\s]|\\r|\\n)*+-----END \1-----")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}

KEYWORDS = {**dict.fromkeys(ASSIGN_WORDS, "assign"), "akia": "access",
            **dict.fromkeys(GITHUB_PREFIXES, "github"), KEY_MARK: "private_key", "npm_": "npm", "eyj": "jwt"}
SCORES = {"assign": 0.6, "access": 0.9, "hex": 0.5, "github": 1.0, "private_key": 1.0, "npm": 1.0, "jwt": 1.0}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def base62_crc(body: str) -> str:
    value, out = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        out = BASE62[digit] + out
    return out.rjust(6, "0")


def json_part(coded: str) -> dict:
    """A part of a token as its JSON object; empty where it is none."""
    try:
        value = json.loads(base64.urlsafe_b64decode(coded + "=" * (-len(coded) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return {}
    return value if isinstance(value, dict) else {}


def lowered(text: str) -> str:
    """Lower case with positions kept: where full lower-casing changes the length, A-Z only."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(ASCII_LOWER)


def find_spans(text: str | None, words: ahocorasick.Automaton) -> list[tuple[str, int, int, float, bool]]:
    """All spans as (kind, start, end, score, base), by start, then kind as listed; null has none."""
    if not text:
        return []
    found = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    free = dict.fromkeys(KEYWORDS.values(), 0)
    hits = sorted((end - size + 1, kind) for end, (kind, size) in words.iter(lowered(text)))
    for start, kind in hits:
        if start < free[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN.match(text, start):
                free[kind] = m.end()
                if m.end(1) - m.start(1) >= ASSIGN_LEAST:
                    found.append((kind, start, m.end()))
        elif kind == "access":
            if m := ACCESS.match(text, start):
                free[kind] = m.end()
                if m.end() - start >= ACCESS_LEAST:
                    found.append((kind, start, m.end()))
        elif kind in ("github", "npm"):
            if (m := (GITHUB if kind == "github" else NPM).match(text, start)) and base62_crc(m[1]) == m[2]:
                free[kind] = m.end()
                found.append((kind, start, m.end()))
        elif kind == "jwt":
            if m := JWT.match(text, start):
                free[kind] = m.end()
                if "alg" in json_part(m[1]) and json_part(m[2]):
                    found.append((kind, start, m.end()))
        elif m := PRIVATE_KEY.match(text, start):
            free[kind] = m.end()
            found.append((kind, start, m.end()))
    order = (*BASE_KINDS, *ADDED_KINDS)
    found.sort(key=lambda s: (s[1], order.index(s[0])))
    return [(*s, SCORES[s[0]], s[0] in BASE_KINDS) for s in found]


def find_secrets(docs: DataFrame) -> DataFrame:
    """Spans of every row: doc_id and parallel arrays kinds, starts, ends, scores, base.

    Positions count code points, the end is exclusive. One row in, one row out:
    null and empty texts give empty arrays, repeated rows repeat, a null doc_id
    stays null, an empty table gives none. Only doc_id and text are read.
    """
    words: list[ahocorasick.Automaton] = []

    def work(columns: dict[str, list]) -> dict[str, list]:
        if not words:
            words.append(automaton())
        spans = [find_spans(text, words[0]) for text in columns["text"]]
        parts = {name: [[s[i] for s in found] for found in spans]
                 for i, name in enumerate(("kinds", "starts", "ends", "scores", "base"))}
        return {"doc_id": columns["doc_id"], **parts}

    return scan(docs.select("doc_id", "text"), work, SCHEMA)
