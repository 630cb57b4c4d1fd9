"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Base kinds (always kept): email, ip (parts to 255), card (16 to 19 digits, Luhn), phone (8 to 15
digits after a plus). The method adds, where the score reaches ``THRESHOLD``: iban (country and
check digits, mod 97), card_short (13 to 15 digits, Luhn, with a word on cards nearby) and
phone_local (7 to 15 digits without a plus, with a word on telephones nearby). For added kinds, what is
proposed too long is tried with its shorter readings: an IBAN up to its country's length (of an unknown
country up to every end), short cards and telephone numbers by the digit groups they consist of.

Spans count code points, end exclusive. A missing or empty text has none; texts of any length are
searched whole in linear time; repeated rows each get their own spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# The base patterns, written so that a failed start is not tried twice.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
TEL = re.compile(r"(?<![0-9+])(?:\([ ()./-]{0,24}+)?[0-9](?:[ ()./-]*+[0-9])+")
PART = re.compile(r"[0-9]+")
ALNUM = re.compile(r"[A-Za-z0-9]")
# Characters of an IBAN by country.
IBAN_LENGTH = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}
DIGIT = re.compile(r"[0-9]")

KINDS = ("email", "ip", "card", "phone", "iban", "card_short", "phone_local")
BASE = KINDS[:4]
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.9,
         "card_short": 0.4, "phone_local": 0.3}
NEAR = {
    "email": re.compile(r"\b(?:e-?mail|contact|mailto)\b", re.I),
    "ip": re.compile(r"\b(?:ip|address|host|server|login)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|telephone|call|mobile|fax|whatsapp)\b", re.I),
    "iban": re.compile(r"\b(?:iban|bank|account|konto)\b", re.I),
}
NEAR |= {"card_short": NEAR["card"], "phone_local": NEAR["phone"]}
AGAINST = re.compile(r"\b(?:isbn|issn|version|order|invoice|page|section|figure)\b", re.I)
WINDOW = 40
RAISE, LOWER = 0.3, 0.3
THRESHOLD = 0.6


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(code: str) -> bool:
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the run in front of an @, from the end of the match before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
        done = match.end() if match else at + 1
        at = text.find("@", done)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The first reading of each start that holds: the length of its country, then the longest."""
    at = 0
    while m := IBAN.search(text, at):
        at = m.start() + 1
        code = m[0].replace(" ", "")
        ends = [i + 1 for i in range(*m.span()) if text[i] != " "]
        whole = [n for n in range(len(ends), 14, -1) if not ALNUM.match(text, ends[n - 1])]
        fixed = IBAN_LENGTH.get(code[:2])
        tried = [n for n in whole if n == fixed] + whole[:1] if fixed else whole
        for n in tried:
            if mod97(code[:n]):
                yield m.start(), ends[n - 1]
                at = ends[n - 1]
                break


def _short_cards(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Neighbouring digit groups of 13 to 15 digits that pass Luhn, from the left, the longest first."""
    parts = [m.span() for m in PART.finditer(text, start, end)]
    i = 0
    while i < len(parts):
        digits, held = "", 0
        for j in range(i, len(parts)):
            digits += text[slice(*parts[j])] if parts[j][1] - parts[j][0] <= 15 else "0" * 16
            if len(digits) > 15:
                break
            if len(digits) >= 13 and luhn(digits):
                held = j + 1
        if held:
            yield parts[i][0], parts[held - 1][1]
        i = held or i + 1


def _numbers(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """A run as telephone numbers: whole if it can be one, else its digit groups dealt into numbers
    that cover most digits, bridge the fewest wide gaps and are most alike in length."""
    parts = [m.span() for m in PART.finditer(text, start, end)]
    if end - start <= 32 and 7 <= sum(b - a for a, b in parts) <= 15:
        yield start, end
        return
    best = [((0, 0, 0), 0)]  # up to each group: the worth, and the first group of the last number
    for j in range(len(parts)):
        found, n, wide = (best[j][0], j + 1), 0, 0
        for i in range(j, -1, -1):
            n += parts[i][1] - parts[i][0]
            if n > 15 or parts[j][1] - parts[i][0] > 32:
                break
            if n >= 7:
                a, b, c = best[i][0]
                found = max(found, ((a + n, b - wide, c - n * n), i), key=lambda x: x[0])
            wide += i > 0 and parts[i][0] - parts[i - 1][1] > 2
        best.append(found)
    spans, j = [], len(parts)
    while j:
        i = best[j][1]
        if i < j:
            spans.append((parts[i][0] - (parts[i][0] > start and text[parts[i][0] - 1] == "("),
                          parts[j - 1][1]))
        j = min(i, j - 1)
    yield from reversed(spans)


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    """Every span that its kind's checks confirm."""
    if "@" in text:
        yield from (("email", a, b) for a, b in _emails(text))
    if not DIGIT.search(text):
        return
    if "." in text:
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        d = _digits(m[0]) if m.end() - m.start() <= 40 else ""
        if 16 <= len(d) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
        elif 13 <= len(d) <= 15 and luhn(d):
            yield "card_short", m.start(), m.end()
        else:
            yield from (("card_short", a, b) for a, b in _short_cards(text, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end()
    yield from (("iban", a, b) for a, b in _ibans(text))
    if NEAR["phone"].search(text):
        for m in TEL.finditer(text):
            yield from (("phone_local", a, b) for a, b in _numbers(text, *m.span()))


def _score(text: str, kind: str, start: int, end: int) -> float:
    around = f"{text[max(0, start - WINDOW):start]} {text[end:end + WINDOW]}"
    score = PRIOR[kind]
    if NEAR[kind].search(around):
        score += RAISE
    if AGAINST.search(around):
        score -= LOWER
    return round(min(1.0, max(0.0, score)), 2)


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then start."""
    if not text:
        return []
    found = [(k, a, b, _score(text, k, a, b)) for k, a, b in _proposed(text)]
    base = [(a, b) for k, a, b, _ in found if k in BASE]
    kept = [x for x in found if x[0] in BASE
            or x[3] >= THRESHOLD and not any(x[1] < b and a < x[2] for a, b in base)]
    return sorted(kept, key=lambda x: (KINDS.index(x[0]), x[1]))


def _joined(spans: Iterable[tuple]) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[] for _ in range(7)]
        for text in batch.column("text"):
            spans = find_spans(text.as_py())
            base = [s for s in spans if s[0] in BASE]
            for i, kind in enumerate(BASE):
                out[i].append(sum(s[0] == kind for s in base))
            out[4].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            out[5].append(_joined(spans))
            out[6].append(",".join(f"{s[3]:.2f}" for s in spans))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in out[:4]],
             *[pa.array(x, pa.string()) for x in out[4:]]],
            names=["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans", "scores"])


def pii_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, digest and spans of every text; no shuffle, one batch in memory at a time."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(_digest, "doc_id long, n_email long, n_ip long, n_card long, "
                                    "n_phone long, base_sha256 string, spans string, "
                                    "scores string")


def redact_text(text: str | None) -> str | None:
    """The text with each span replaced by its kind in angle brackets; overlaps go together."""
    spans = sorted(find_spans(text), key=lambda s: (s[1], -s[2]))
    if not spans:
        return text
    pieces, at = [], 0
    for kind, start, end, _ in spans:
        if start >= at:
            pieces += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(pieces) + text[at:]


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``length`` counted again."""
    schema, where = docs.schema, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array([redact_text(t.as_py()) for t in batch.column(where)], pa.string())
            yield batch.set_column(where, text, new)

    out = docs.mapInArrow(run, schema)
    if length and length in docs.columns:
        kind = schema[length].dataType
        out = out.withColumn(length, F.char_length(f"`{text}`").cast(kind))
    return out
