"""Personal data with offset-preserving deobfuscation.

Plain forms are found in the text as it stands.  Then a transducer rewrites disguises piece by piece:
homoglyphs and full-width signs to ASCII, invisible signs to nothing, spelled digits to digits, "(at)",
"[dot]", " at ", " dot " to the signs.  It keeps, for each character it writes, the source span
it came from.  The same detectors run over the rewritten text, and their spans are mapped back.
Every text is one row's work: no shuffle, memory bounded by the longest text.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds in their order, and the plain patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match always takes a whole run of digits, so looking only at the start of runs changes nothing but the time.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Cyrillic and Greek letters that look like ASCII ones.
LOOKALIKES = dict(zip("аеорсухіјѕһԁոАВЕКМНОРСТХЅІЈοαινρυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijshdnABEKMHOPCTXSIJoaivpuABEZHIKMNOPTYX"))
INVISIBLE = "­​‌‍⁠﻿"
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
_DIGIT_WORD = "|".join(SPELLED)
#: Runs of at least four spelled digits; a lone "one" is left alone.
_SPELLED_RUN = rf"(?<![^\W_])(?:plus[ -])?(?:{_DIGIT_WORD})(?:[ ,.-]{{1,2}}(?:{_DIGIT_WORD})){{3,}}(?![^\W_])"
_BRACKET_AT = r"[ ]?[(\[{<][ ]?(?:at|@)[ ]?[)\]}>][ ]?"
_BRACKET_DOT = r"[ ]?[(\[{<][ ]?(?:dot|punkt|\.)[ ]?[)\]}>][ ]?"
_SPACED_AT = r"(?<=[A-Za-z0-9])[ ]+at[ ]+(?=[A-Za-z0-9-]+(?:[ ]+dot[ ]+|[ ]?[(\[{<][ ]?dot|\.[A-Za-z]{2}))"
_SPACED_DOT = r"(?<=[A-Za-z0-9])[ ]+dot[ ]+(?=[A-Za-z0-9])"
DISGUISE = re.compile(
    f"(?P<run>{_SPELLED_RUN})|(?P<at>{_BRACKET_AT}|{_SPACED_AT})|(?P<dot>{_BRACKET_DOT}|{_SPACED_DOT})"
    f"|(?P<odd>[{INVISIBLE}{''.join(LOOKALIKES)}！-～٠-٩۰-۹०-९\U0001d7ce-\U0001d7ff])",
    re.IGNORECASE,
)
_ODD = re.compile(rf"[{INVISIBLE}{''.join(LOOKALIKES)}！-～٠-٩۰-۹०-९\U0001d7ce-\U0001d7ff]")
#: Quick searches, one of which hits in any text that holds a disguise.  " at " alone is no sign:
#: what it disguises must hold a dot or "dot" after it.
TRIGGERS = (
    re.compile(r"[(\[{<][ ]?(?:at|@|dot|punkt|\.)[ ]?[)\]}>]", re.IGNORECASE),
    re.compile(r"[ ]dot[ ]", re.IGNORECASE),
    re.compile(r"[ ]at[ ]+[a-z0-9-]+\.[a-z]{2}", re.IGNORECASE),
    re.compile(rf"(?:{_DIGIT_WORD})[ ,.-]{{1,2}}(?:{_DIGIT_WORD})[ ,.-]", re.IGNORECASE),
)
_DIGIT_TOKEN = re.compile(_DIGIT_WORD, re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) * (1 + place % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[str, int, int]]:
    """Addresses around each "@": local part as far left as the last match allows, then the domain.  Linear in the text."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append(("email", start, free))
        at = text.find("@", at + 1)
    return found


def detect(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of plain forms: leftmost and non-overlapping per kind; failing matches are dropped."""
    found = emails(text)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return found


def rewrite(text: str) -> tuple[str, list[int], list[int], list[bool]]:
    """The text without disguises, and for each of its characters: source start, source end, whether it was rewritten."""
    out: list[str] = []
    starts: list[int] = []
    ends: list[int] = []
    changed: list[bool] = []

    def write(piece: str, start: int, end: int) -> None:
        out.append(piece)
        starts.extend([start] * len(piece))
        ends.extend([end] * len(piece))
        changed.extend([True] * len(piece))

    at = 0
    for m in DISGUISE.finditer(text):
        out.append(text[at : m.start()])
        starts.extend(range(at, m.start()))
        ends.extend(range(at + 1, m.start() + 1))
        changed.extend([False] * (m.start() - at))
        if m["run"]:
            if m[0][:4].lower() == "plus":
                write("+", m.start(), m.start() + 4)
            for d in _DIGIT_TOKEN.finditer(m[0]):
                write(SPELLED[d[0].lower()], m.start() + d.start(), m.start() + d.end())
        elif m["at"]:
            write("@", *m.span())
        elif m["dot"]:
            write(".", *m.span())
        elif m[0] not in INVISIBLE:
            plain = LOOKALIKES.get(m[0]) or unicodedata.normalize("NFKC", m[0])
            if not plain.isascii():
                plain = str(unicodedata.digit(m[0], m[0]))
            write(plain, *m.span())
        at = m.end()
    out.append(text[at:])
    starts.extend(range(at, len(text)))
    ends.extend(range(at + 1, len(text) + 1))
    changed.extend([False] * (len(text) - at))
    return "".join(out), starts, ends, changed


def disguised(text: str, plain: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Source spans of identifiers that show only after rewriting and touch no plain span."""
    if not any(t.search(text) for t in TRIGGERS) and (text.isascii() or not _ODD.search(text)):
        return []
    clear, starts, ends, changed = rewrite(text)
    # Invisible signs leave no character; a span that jumps over one counts as rewritten too.
    extra = []
    # A number that was spelled out needs no "+" to be taken for a phone number.
    found = detect(clear) + [
        ("phone", *m.span()) for m in re.finditer(r"(?<![0-9+])[0-9]{10,15}(?![0-9])", clear) if all(changed[m.start() : m.end()])
    ]
    for kind, a, b in found:
        start, end = starts[a], ends[b - 1]
        whole = all(ends[i] == starts[i + 1] for i in range(a, b - 1)) and not any(changed[a:b])
        if not whole and not any(start < e and s < end for _, s, e in plain):
            extra.append((kind, start, end))
    return extra


def listed(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def spans_of(text: str) -> tuple[list, list]:
    plain = detect(text)
    return plain, disguised(text, plain)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, found array<struct<kind, start, end, plain>>) of every row; null texts count as empty.

    Offsets are code points, ends exclusive.  Repeated rows and null ids stay as they are; further
    columns are ignored; an empty table gives an empty result.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())]))

    def run(batches):
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                plain, extra = spans_of(text)
                rows = [(*s, True) for s in plain] + [(*s, False) for s in extra]
                found.append([dict(zip(("kind", "start", "end", "plain"), r)) for r in rows])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "found"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, found array<struct<kind:string,start:long,end:long,plain:boolean>>"
    )


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the plain spans, and the list of all spans (cases as in ``find``)."""
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches):
        for batch in batches:
            counts: dict[str, list[int]] = {k: [] for k in KINDS}
            digests, spans = [], []
            for text in batch.column("text").to_pylist():
                plain, extra = spans_of(text)
                for k in KINDS:
                    counts[k].append(sum(s[0] == k for s in plain))
                digests.append(hashlib.sha256(listed(plain).encode()).hexdigest())
                spans.append(listed(plain + extra))
            columns = [*(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )
