"""Personal data: patterns propose, checksums confirm, nearby words move the score (operator 5).

Base kinds: email, ip, card (Luhn) and phone. A match of a base kind that passes its check is always reported,
whatever its score. The method adds spans of two kinds, which need a score of ``ACCEPT``: iban (mod-97, and a
length of 15 to 34) and id (nine digits in groups of 3-2-4, only with a word such as "ssn" nearby).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolith.llm.common import like

KINDS = ["email", "ip", "card", "phone", "iban", "id"]
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "id": r"\b[0-9]{3}[ -][0-9]{2}[ -][0-9]{4}\b",
}
_COMPILED = {k: re.compile(v) for k, v in PATTERNS.items()}
#: An e-mail from its "@" outwards (the pattern itself would look at every run of name characters).
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
#: Words that speak for a kind, and against personal data at all; looked for ``NEAR`` characters around.
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("address", "host", "server", "login"), "card": ("card", "visa", "pay", "credit"),
    "phone": ("call", "phone", "tel", "mobile"), "iban": ("iban", "account", "bank", "transfer"), "id": ("ssn", "social", "identity", "tax"),
}
AGAINST = ("example", "version", "isbn", "order", "invoice", "sample")
NEAR = 40
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "id": 0.3}
LIFT, DROP, ACCEPT = 0.3, 0.3, 0.5
BASE = KINDS[:4]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def valid(kind: str, match: str) -> bool:
    """The check behind each pattern."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in match.split("."))
    if kind == "iban":
        code = match.replace(" ", "")
        return 15 <= len(code) <= 34 and mod97(code)
    digits = re.sub("[^0-9]", "", match)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def score(kind: str, text: str, start: int, end: int) -> float:
    """Prior of the kind, moved by words nearby; between 0 and 1."""
    around = (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower()
    value = PRIOR[kind]
    value += LIFT * any(w in around for w in CONTEXT[kind])
    value -= DROP * any(w in around for w in AGAINST)
    return min(1.0, max(0.0, value))


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind; code points, end exclusive. None and "" have none."""
    if not text:
        return []
    out = []
    digits = re.search("[0-9]", text) is not None
    for kind in KINDS:
        if kind == "email":
            if "@" not in text:
                continue
        elif not digits or (kind == "ip" and "." not in text) or (kind == "phone" and "+" not in text):
            continue
        for m in _COMPILED[kind].finditer(text) if kind != "email" else _emails(text):
            if valid(kind, m[0]):
                s = score(kind, text, m.start(), m.end())
                if kind in BASE or s >= ACCEPT:
                    out.append((kind, m.start(), m.end(), s))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _emails(text: str) -> Iterator[re.Match]:
    """The leftmost matches in order, found from each "@": a match starts where its run of name characters does."""
    done, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > done and _LOCAL.fullmatch(text[lo - 1]):
            lo -= 1
        m = _COMPILED["email"].match(text, lo) if lo < at else None
        if m:
            yield m
            done = m.end()
        at = text.find("@", max(done, at + 1))


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, found (array of kind, start, end, score): one row per row of ``docs``; no span gives an empty array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                found = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find_spans(t)] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.list_(kind))], ["doc_id", "found"])

    narrow = like(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, found array<struct<kind string, start long, end long, score double>>")


def redact(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first, then longest, stands."""
    if not text:
        return text
    out, at = [], 0
    for kind, start, end, _ in sorted(find_spans(text), key=lambda x: (x[1], -x[2])):
        if end <= at:
            continue
        if start < at:  # overlaps what is gone already: the rest goes with it
            at = end
            continue
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join(out) + text[at:]


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with all rows and columns, personal data in ``text`` replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index("text")
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                yield part.set_column(k, "text", pa.array([redact(t) for t in part.column(k).to_pylist()], pa.string()))

    return docs.mapInArrow(run, docs.schema)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and the joined spans of each row."""
    found = spans(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[], [], [], [], [], []]
            for own in batch.column("found").to_pylist():
                names = [s["kind"] for s in own]
                for k, kind in enumerate(BASE):
                    rows[k].append(names.count(kind))
                base, every = (",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in own if s["kind"] in kinds) for kinds in (BASE, KINDS))
                rows[4].append(hashlib.sha256(base.encode()).hexdigest())
                rows[5].append(every)
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(r, t) for r, t in zip(rows, types, strict=True))],
                                             ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    return found.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
