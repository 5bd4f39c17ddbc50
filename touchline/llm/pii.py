"""Personal-data spans: patterns propose, checksums confirm, context words adjust.

Base kinds (email, ip, card, phone) follow fixed patterns and stay whatever their score.
Further kinds (iban, ssn, local phone, secret) are proposed by a pattern, confirmed by a
checksum, a range rule or their entropy, and kept when their score, moved by nearby words,
reaches ``KEEP``.  Offsets are in code points, ends exclusive.

Every pattern runs in time linear in the text: e-mail matches are found from their ``@``
outwards, and digit runs are matched whole (possessive), as no shorter part of a run could
match either.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from hashlib import sha256
from itertools import accumulate
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from touchline.llm.common import texts_of, with_arrow_columns

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("iban", "ssn", "localphone", "secret")
KINDS = BASE_KINDS + EXTRA_KINDS

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
#: Words that a secret is assigned to, what may stand before them, and the assignment with its value.
_KEY_WORDS = (b"key", b"token", b"secret", b"passw", b"pwd", b"passphrase", b"credential")
_BEFORE = re.compile(rb"(?:^|[^a-z0-9])(?:api|access|secret|private|auth|client|session|refresh|bearer)?[_ -]?$")
_ASSIGNED = re.compile(r"""(?i:key|token|secret|passw(?:or)?d|pwd|passphrase|credentials?)["']?[ \t]{0,4}(?::=|=>|[:=])[ \t]{0,4}["'`]?
    ([A-Za-z0-9+/_.=~!@$%^&*-]{8,256}+)""", re.X)
#: Values of a known form, with a text that each of them holds.
_FORMS = ((b"AKIA", re.compile(r"(?<![A-Za-z0-9])(AKIA[0-9A-Z]{16})(?![A-Za-z0-9])")),
          (b"gh", re.compile(r"(?<![A-Za-z0-9])(gh[pousr]_[A-Za-z0-9]{36})(?![A-Za-z0-9])")),
          (b"xox", re.compile(r"(?<![A-Za-z0-9])(xox[abprs]-[A-Za-z0-9-]{10,72}+)(?![A-Za-z0-9])")))
#: Bits a character that tell a drawn string from a word.
SECRET_BITS = 2.5

#: Score of a proposal by itself; a checksum adds CONFIRMED, words nearby move it.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.4, "ssn": 0.35, "localphone": 0.3, "secret": 0.4}
CONFIRMED = {"card": 0.4, "iban": 0.5, "secret": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "credit", "payment"), "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"), "ssn": ("ssn", "social", "security"),
    "localphone": ("phone", "tel", "call", "mobile", "fax", "telefon", "contact"),
    "secret": ("login", "credential", "credentials", "secret", "auth", "private", "bearer"),
}
AGAINST = ("version", "isbn", "invoice", "order", "serial", "sku", "example")
KEEP, WINDOW = 0.5, 40
_WORDS = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    """The check digit of payment cards."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(text: str) -> bool:
    """The check digits of an IBAN (spaces allowed)."""
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _emails(text: str):
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str):
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m.group().split("."))
        if all(len(p) < 4 and int(p or "0") <= 255 for p in parts):
            yield m.span()


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str):
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m.group())) <= 15:
                yield m.span()


def _ibans(text: str):
    """The longest confirmed reading of each proposal; a following capital word may have been taken in."""
    for m in _IBAN.finditer(text):
        found = m.group()
        ends = [len(found)] + [i for i in range(len(found) - 1, 14, -1) if found[i] == " "]
        for end in ends:
            if mod97(found[:end]):
                yield m.start(), m.start() + end
                break


def _ssns(text: str):
    for m in _SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def entropy(text: str) -> float:
    """Bits a character, from the text's own frequencies."""
    n = len(text)
    return -sum(c / n * log2(c / n) for c in Counter(text).values())


def _assigned(text: str):
    """Matches of ``_ASSIGNED`` at the key words, each found by a plain search; other characters are one byte each."""
    plain = text.encode("ascii", "replace")
    low = plain.lower()
    hits = []
    for word in _KEY_WORDS:
        at = low.find(word)
        while at >= 0:
            hits.append(at)
            at = low.find(word, at + 1)
    done = 0
    for at in sorted(hits):
        if at >= done and _BEFORE.search(low[max(0, at - 10):at]):
            m = _ASSIGNED.match(text, at)
            if m:
                done = m.end()
                yield m
    for mark, form in _FORMS:
        if mark in plain:
            yield from form.finditer(text)


def _secrets(text: str):
    """Values with letters and digits that look drawn at random; a plain word after ``password:`` is none."""
    found = set()
    for m in _assigned(text):
        value = m.group(1).rstrip(".!")  # a sentence may end here
        mixed = any(map(str.isdigit, value)) and any(map(str.isalpha, value))
        if len(value) >= 8 and mixed and entropy(value) >= SECRET_BITS:
            found.add((m.start(1), m.start(1) + len(value)))
    return sorted(found)


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "ssn": _ssns,
            "secret": _secrets, "localphone": lambda text: (m.span() for m in _LOCAL_PHONE.finditer(text))}


def score(text: str, kind: str, start: int, end: int) -> float:
    """Prior plus checksum, up 0.3 for a supporting word nearby, down 0.3 for an opposing one."""
    near = text[max(0, start - WINDOW):start] + " " + text[end:end + WINDOW]
    if kind == "secret":  # the parts of an address nearby say nothing about it
        near = " ".join(w for w in near.split() if "@" not in w)
    words = set(_WORDS.findall(near.lower()))
    value = PRIOR[kind] + CONFIRMED.get(kind, 0.0)
    value += 0.3 * (not words.isdisjoint(CONTEXT[kind])) - 0.3 * (not words.isdisjoint(AGAINST))
    return min(1.0, max(0.0, round(value, 2)))


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind as listed in KINDS.

    Extra kinds give way to a base span that they overlap.
    """
    base = [(k, s, e, score(text, k, s, e)) for k in BASE_KINDS for s, e in _FINDERS[k](text)]
    extra = [(k, s, e, score(text, k, s, e)) for k in EXTRA_KINDS for s, e in _FINDERS[k](text)]
    if extra and base:
        taken = sorted((s, e) for _, s, e, _ in base)
        starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))  # the furthest end so far

        def free(start: int, end: int) -> bool:
            before = bisect_left(starts, end)
            return not before or reach[before - 1] <= start

        extra = [x for x in extra if free(x[1], x[2])]
    extra = [x for x in extra if x[3] >= KEEP]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(base + extra, key=lambda x: (x[1], order[x[0]], x[2]))


def spans_text(spans: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)


def redact(text: str, spans: list) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    for kind, start, end, _ in spans:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def pii_table(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: counts per base kind, digest of the base spans, all spans and their scores.

    A null text is read as empty; it has no spans, and its digest is that of the empty
    text.  Repeated rows give repeated rows, null keys pass through, an empty table gives an
    empty result; other columns are not read.
    """
    fields = [T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS]
    fields += [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans", "scores")]

    def compute(batch: pa.RecordBatch) -> list:
        rows = []
        for value in texts_of(batch, text):
            spans = find_spans(value)
            base = [s for s in spans if s[0] in BASE_KINDS]
            counts = [sum(s[0] == k for s in base) for k in BASE_KINDS]
            rows.append((*counts, sha256(spans_text(base).encode()).hexdigest(), spans_text(spans),
                         ",".join(f"{s[3]:.2f}" for s in spans)))
        return list(zip(*rows))

    return with_arrow_columns(docs.select(key, text), fields, compute, keep=[key])


def redact_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` (same columns) with every span in ``text`` replaced; ``n_chars``, if present, follows a changed text."""
    fields = [T.StructField("tl_text", docs.schema[text].dataType), T.StructField("tl_chars", T.LongType())]

    def compute(batch: pa.RecordBatch) -> list:
        new, chars = [], []
        for value in batch.column(batch.schema.get_field_index(text)).to_pylist():
            spans = find_spans(value) if value else []
            new.append(redact(value, spans) if spans else value)
            chars.append(len(new[-1]) if spans else None)
        return [new, chars]

    out = with_arrow_columns(docs, fields, compute)
    columns = [out["tl_text"].alias(c) if c == text else out[c] for c in docs.columns]
    if "n_chars" in docs.columns:
        from pyspark.sql import functions as F

        at = docs.columns.index("n_chars")
        fresh = F.coalesce(out["tl_chars"].cast(docs.schema["n_chars"].dataType), out["n_chars"])
        columns[at] = fresh.alias("n_chars")
    return out.select(*columns)
