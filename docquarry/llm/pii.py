"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

Base kinds (email, ip, card, phone) are reported whenever their fixed pattern and validator hold; the
score only ranks them.  Added kinds (iban, ssn, local_phone, ipv6) are weaker patterns, reported only where
checksum and context bring their score to ACCEPT, and never inside a base span.
Everything is one pass over the text; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docquarry.llm.kernels import slices, text_bytes

# Base patterns and their order.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "local_phone", "ipv6")
EMAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match always starts at the first digit of a run, so looking behind changes no result.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])")
IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")

#: Characters before a span that are searched for context words.
WINDOW = 48
ACCEPT = 0.6
PRIOR = {
    "email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.7, "ssn": 0.35, "local_phone": 0.35, "ipv6": 0.7,
}
FOR = {
    "email": ("mail", "contact"),
    "ip": ("address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax"),
    "ipv6": ("address", "host", "server"),
}
AGAINST = {
    "ip": ("version", "release", "section"),
    "card": ("isbn", "order", "serial"),
    "ssn": ("part", "model", "invoice"),
    "local_phone": ("part", "model", "invoice"),
}
STEP = 0.3


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Check digits of an international account number."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; found from each @, so a long run of letters costs one look."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in EMAIL_CHARS:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str, digits: bool = True) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind.  ``digits`` tells whether the text has any."""
    found = [("email", *span) for span in _emails(text)]
    if digits:
        for m in IP.finditer(text):
            if all(map(_small, m.group().split("."))):
                found.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            number = _digits(m.group()) if m.end() - m.start() < 40 else ""
            if 14 <= len(number) <= 19 and luhn(number):
                found.append(("card", *m.span()))
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], BASE.index(s[0])))


def _score(text: str, kind: str, start: int) -> float:
    before = text[max(0, start - WINDOW) : start].lower()
    score = PRIOR[kind]
    score += STEP * any(word in before for word in FOR[kind])
    score -= STEP * any(word in before for word in AGAINST.get(kind, ()))
    return round(min(1.0, max(0.0, score)), 3)


def all_spans(text: str, digits: bool = True) -> list[tuple[str, int, int, float, bool]]:
    """Base spans and accepted added ones: kind, start, end, score, whether base."""
    base = base_spans(text, digits)
    found = [(kind, start, end, _score(text, kind, start), True) for kind, start, end in base]
    if digits:
        for kind, pattern in zip(ADDED, (IBAN, SSN, LOCAL_PHONE, IPV6)):
            for m in pattern.finditer(text):
                start, end = m.span()
                if any(s < end and start < e for _, s, e in base):
                    continue
                if kind == "iban" and not mod97(m.group().replace(" ", "")):
                    continue
                score = _score(text, kind, start)
                if score >= ACCEPT:
                    found.append((kind, start, end, score, False))
    kinds = BASE + ADDED
    return sorted(found, key=lambda s: (s[1], kinds.index(s[0])))


_SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]
)
_SPANS = "array<struct<kind:string,start:long,end:long,score:double,base:boolean>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.name for field in _SPAN]
    for batch in slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        digit = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
        digits = (digit[offsets[1:]] > digit[offsets[:-1]]).tolist()
        at = np.concatenate([[0], np.cumsum(data == 64)])
        emails = (at[offsets[1:]] > at[offsets[:-1]]).tolist()
        spans = []
        for text, has_digits, has_at in zip(batch.column("text"), digits, emails):
            found = all_spans(text.as_py(), has_digits) if has_digits or has_at else []
            spans.append([dict(zip(names, s)) for s in found])
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, pa.list_(_SPAN))], names=["id", "found"])


def find_pii(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, found`` for each row; ``found`` is an array of kind, start, end, score, base.

    Positions count code points of the whole text, the end is exclusive; spans are in order of start, then
    kind.  NULL and empty texts have none.  Repeated rows give repeated results; other columns are not
    read; an empty table gives an empty result.
    """
    kind = docs.schema[id].dataType.simpleString()
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return source.mapInArrow(_find, f"id {kind}, found {_SPANS}").withColumnRenamed("id", id)


def mask_pii(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with every found span replaced by its kind in angle brackets; all columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            masked = []
            for value in batch.column(text).to_pylist():
                done, parts = 0, []
                for kind, start, end, _, _ in all_spans(value) if value else []:
                    if start >= done:
                        parts += [value[done:start], f"<{kind}>"]
                        done = end
                masked.append("".join([*parts, value[done:]]) if value is not None else None)
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(masked, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
