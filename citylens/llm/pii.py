"""Personal data: patterns propose spans, checksums confirm, context scores.

Base kinds (always kept once proposed and confirmed): ``email``, ``ip`` (parts
at most 255), ``card`` (14 to 19 digits passing Luhn), ``phone`` (``+`` and 10
to 15 digits).  The score adds ``iban`` (mod-97), ``card13`` (13 digits passing
Luhn), ``ssn`` and ``phone_local``; a pattern without a strong checksum needs a
context word near by.  Positions are code points, the end is exclusive.

Every pattern is anchored at the start of its run of signs, so that the work is
linear in the text however long a run is.

Defined results: a null text is empty; an empty text has no spans; every row,
repeated or without id, gives its own row; an empty table gives an empty one;
further columns are ignored.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import arrow_map, pick, release, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "card13", "ssn", "phone_local")
#: least score of a span that the method adds
KEEP_FROM = 0.8
#: code points looked at on either side of a span for context words
NEAR = 48

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_PHONE_LOCAL = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
_ANY = re.compile("[0-9@]")

#: score of a confirmed span before its context, and the words that raise it
_START = {"email": 0.9, "ip": 0.8, "card": 0.9, "phone": 0.8, "iban": 0.85, "card13": 0.6, "ssn": 0.5, "phone_local": 0.5}
_CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "card13": ("card", "visa", "credit", "debit", "payment"),
    "ssn": ("ssn", "social security"),
    "phone_local": ("phone", "tel", "call", "mobile", "fax"),
}
_CONTEXT_RE = {k: re.compile(r"\b(?:" + "|".join(w) + ")", re.IGNORECASE) for k, w in _CONTEXT.items()}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 check of an IBAN without spaces."""
    moved = iban[4:] + iban[:4]
    return 15 <= len(iban) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str):
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        else:
            done = at + 1
        at = text.find("@", done)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _confirmed(text: str):
    """(kind, start, end) of base spans."""
    for s, e in _emails(text):
        yield "email", s, e
    for m in _IP.finditer(text):
        if all(len(q) <= 3 and int(q or "0") <= 255 for q in (p.lstrip("0") for p in m[0].split("."))):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end()


def _proposed(text: str):
    """(kind, start, end) of the spans that the score decides on."""
    for m in _IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            yield "iban", m.start(), m.end()
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if len(d) == 13 and luhn(d):
            yield "card13", m.start(), m.end()
    for kind, pattern in (("ssn", _SSN), ("phone_local", _PHONE_LOCAL)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()


def score(text: str, kind: str, start: int, end: int) -> float:
    """Confidence of a confirmed span: raised by a context word of its kind near by."""
    pattern = _CONTEXT_RE[kind]
    near = pattern.search(text, max(0, start - NEAR), start) or pattern.search(text, end, end + NEAR)
    return min(1.0, _START[kind] + (0.3 if near else 0.0))


def find(text: str) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) by start, then kind as listed."""
    if not _ANY.search(text):
        return []
    base = list(_confirmed(text))
    spans = [(k, s, e, score(text, k, s, e), True) for k, s, e in base]
    held = sorted((s, e) for _, s, e in base)
    for k, s, e in _proposed(text):
        if (c := score(text, k, s, e)) >= KEEP_FROM and not any(a < e and s < b for a, b in _around(held, s, e)):
            spans.append((k, s, e, c, False))
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def _around(held, start, end):
    """Spans of a sorted list that can touch [start, end)."""
    from bisect import bisect_left

    i = bisect_left(held, (start, start))
    return held[max(0, i - 4): bisect_left(held, (end, end))]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): spans is an array of (kind, start, end, score, base)."""
    def run(batch):
        release()
        return {"doc_id": batch.column("doc_id"),
                "spans": [[dict(zip(("kind", "start", "end", "score", "base"), s, strict=True)) for s in find(t)] for t in texts_of(batch)]}

    return arrow_map(pick(docs, doc_id=id_col, text=text_col), run,
                     "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double,base:boolean>>")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of ``find_pii``'s spans, one row per document."""
    spans = find_pii(docs, id_col, text_col)
    base = F.filter("spans", lambda s: s["base"])

    def joined(a):
        return F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in BASE_KINDS]
    return spans.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        F.transform("spans", lambda s: s["score"]).alias("scores"))


def redacted(text: str) -> str:
    """The text with every span replaced by its kind, e.g. ``[EMAIL]``; spans
    that overlap become one, named by the first."""
    spans = find(text)
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i][:3]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced; null stays null."""
    @F.pandas_udf(StringType())
    def clean(texts: pd.Series) -> pd.Series:
        release()
        return texts.map(lambda t: t if t is None else redacted(t))

    cols = docs.columns
    at = cols.index(text_col)
    flat = docs.toDF(*[f"_c{i}" for i in range(len(cols))])
    return flat.withColumn(f"_c{at}", clean(f"_c{at}")).toDF(*cols)


