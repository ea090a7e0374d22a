"""Secret scans: an Aho-Corasick keyword prefilter, anchored regular expressions only near hits, then checksums.

The automaton goes over the lower-cased (A-Z) text once; at each keyword hit the regular expressions of that keyword
are tried at that very place. Tokens that embed a checksum count only where it is right. The hex kind has no keyword
and is one search for runs of 32 or more.

Edge cases: a null or empty text has no span; spans of different kinds may overlap and are all reported, those of one
kind never overlap; equal rows give equal results; an empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib

import ahocorasick
from pyspark.sql import DataFrame

from logspark.llm.common import LOWER, hold, id_text, map_rows

BASE = ("assign", "access", "hex")
# Token prefixes and forms as their issuers publish them.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
NPM = re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
SLACK = re.compile(r"xox[abprs]-[0-9]{8,14}-[A-Za-z0-9-]{10,}")
GOOGLE = re.compile(r"AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])")
STRIPE = re.compile(r"[sr]k_live_[0-9a-zA-Z]{24,}")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+")
PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )?PRIVATE KEY-----")
DIGITS62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc62(token: str) -> bool:
    """The last six characters are the CRC-32 of those after the prefix, in base 62."""
    body, tail = token.split("_", 1)[1][:-6], token[-6:]
    crc, out = zlib.crc32(body.encode()), ""
    while crc:
        crc, d = divmod(crc, 62)
        out = DIGITS62[d] + out
    return out.rjust(6, "0") == tail


def jwt_header(token: str) -> bool:
    """The first part is base64 of a JSON object that names an algorithm; one nested too deep for the JSON parser doesn't count."""
    head = token.split(".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, binascii.Error, TypeError, RecursionError):
        return False


#: kind -> (keywords in lower case, pattern at the keyword, validation)
RULES = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), ASSIGN, lambda m: len(m[2]) >= 8),
    "access": (("akia",), ACCESS, lambda m: len(m[0]) >= 16),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), GITHUB, lambda m: crc62(m[0])),
    "npm": (("npm_",), NPM, lambda m: crc62(m[0])),
    "slack": (("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"), SLACK, None),
    "google": (("aiza",), GOOGLE, None),
    "stripe": (("sk_live_", "rk_live_"), STRIPE, None),
    "jwt": (("eyj",), JWT, lambda m: jwt_header(m[0])),
    "pem": (("-----begin ",), PEM, None),
}
#: Where such a kind finds nothing, the run it began in is passed over and the next run tried. A pattern that fails at a
#: run's start fails in all of it, as what follows the run is the same; so a text of hits in one run is read once.
RUNS = {"jwt": re.compile(r"eyJ[A-Za-z0-9_-]*+")}
ORDER = {k: i for i, k in enumerate([*BASE, *(k for k in RULES if k not in BASE)])}


def machine() -> ahocorasick.Automaton:
    of = ahocorasick.Automaton()
    for kind, (keys, _, _) in RULES.items():
        for k in keys:
            of.add_word(k, (len(k), kind))
    of.make_automaton()
    return of


def find(data: bytes, of: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then kind as listed."""
    text = data.decode("utf-8", "replace")
    spans = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    over: dict[str, int] = {}
    for end, (length, kind) in of.iter(data.translate(LOWER).decode("utf-8", "replace")):
        start = end - length + 1
        if start < over.get(kind, 0):
            continue
        _, pattern, valid = RULES[kind]
        m = pattern.match(text, start)
        good = m is not None and (valid is None or valid(m))
        if good:
            spans.append((start, m.end(), kind))
        if kind in RUNS and not good:
            run = RUNS[kind].match(text, start)
            over[kind] = run.end() if run else start
        elif m:
            over[kind] = m.end()  # a match that is dropped is not tried again
    return sorted(spans, key=lambda s: (s[0], ORDER[s[2]], s[1]))


def told(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def row(doc_id, data: bytes, of) -> tuple:
    spans = find(data, of)
    base = [s for s in spans if s[2] in BASE]
    n = [sum(s[2] == k for s in base) for k in BASE]
    return doc_id, *n, hashlib.sha256(told(base).encode()).hexdigest(), told(spans)


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: counts of the base kinds, digest of their spans, and all spans as kind:start:end."""
    return map_rows(id_text(df, id_col, text_col), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", row, ("secrets", machine))


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]", count_col: str | None = None) -> DataFrame:
    """df with each secret in text_col replaced by mark (overlapping spans by one); null stays null.

    count_col, if given, is set to the new text's code points. All other columns and their order are kept.
    """
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def clean(texts):
        of = hold("secrets", machine)

        def one(text):
            if text is None:
                return None
            out, at, until = [], 0, 0
            for a, b, _ in find(text.encode(), of):
                if a >= until:
                    out += [text[at:a], mark]
                    at = until = b
                elif b > until:
                    at = until = b
            return "".join(out) + text[at:] if out else text

        return texts.map(one, na_action=None)

    out = df.withColumn(text_col, clean(F.col(f"`{text_col}`").cast("string")))
    return out.withColumn(count_col, F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast(df.schema[count_col].dataType)) if count_col else out
