"""Personal data: regular expressions propose spans, checksums confirm them, nearby context words adjust the score.

``find`` works on one text, ``detect`` on a DataFrame, ``redact`` replaces what was found. Base kinds (email, ip, card,
phone) are confirmed by shape and checksum alone; context only moves their score. The other kinds (iban: mod-97; jwt: its
coded head; ssn and secret: shapes that are common by chance) count from ``MIN_SCORE`` on, which the last two reach only by context words. Words
before and behind a match raise its score, others before it lower it.

Nulls, empties: a null or empty text has no spans. Each row is judged by itself, so repeated rows, ties, null ids and extra
columns change nothing. Every expression runs in time linear in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import fresh, over_texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "secret", "jwt")
#: What a match is worth before its context is read.
SHAPE_SCORE = {"email": 0.95, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.35, "secret": 0.3, "jwt": 0.7}
MIN_SCORE = 0.5
CONTEXT_BONUS = 0.35
CONTEXT_PENALTY = 0.2
#: Code points before and behind a match that are read for context words.
CONTEXT_WIDTH = 48
CONTEXT_BEHIND = 24
CONTEXT = {
    "email": re.compile(r"e-?mail|contact|mailto|write to", re.I),
    "ip": re.compile(r"\bip\b|address|host|server", re.I),
    "card": re.compile(r"card|visa|credit|debit|payment|tarjeta|carte|karte", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax|teléfono|téléphone", re.I),
    "iban": re.compile(r"iban|account|bank|konto|cuenta|compte", re.I),
    "ssn": re.compile(r"ssn|social security|tax id", re.I),
    "secret": re.compile(r"token|secret|api[_ -]?key|passw(?:or)?d|bearer", re.I),
    "jwt": re.compile(r"token|secret|authori[sz]ation|bearer|cookie", re.I),
}
#: Words before a match that speak against it.
CONTEXT_AGAINST = {
    "ip": re.compile(r"version|release|build|chapter|section", re.I),
    "card": re.compile(r"order|invoice|isbn|serial|tracking|barcode", re.I),
    "phone": re.compile(r"order|invoice|serial|tracking|tax", re.I),
    "iban": re.compile(r"serial|part no|model", re.I),
    "ssn": re.compile(r"order|invoice|serial|part no|model", re.I),
    "secret": re.compile(r"checksum|sha-?\d+|md5|commit|digest", re.I),
}
#: Possessive forms: a failed match gives up at once, so long runs cost no backtracking.
AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: The country and check digits of an IBAN, and what may follow them; where it ends, lengths and mod-97 decide.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?: ?[A-Z0-9]){11})")
IBAN_REST = re.compile(r"(?: ?[A-Z0-9]){11,30}")
IBAN_LENGTH = {
    c: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in countries.split()
}
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
#: A secret: a run with a digit, from its start or from behind a mark in it to its end.
SECRET = re.compile(r"[A-Za-z0-9_/+-]{24,}+")
LEAST_SECRET = 24
#: What may follow a secret behind a dot and still be part of it.
SECRET_REST = re.compile(r"(?:\.[A-Za-z0-9_/+-]{8,}+)++")
#: A signed web token: its head is coded JSON, which always begins so.
JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{4,}+(?:\.[A-Za-z0-9_-]*+)?")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    """Whether a digit string passes the Luhn check."""
    own = sum(map(int, digits[-1::-2])) + sum(_DOUBLED[int(d)] for d in digits[-2::-2])
    return own % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN without spaces leaves 1 modulo 97 after its first four characters move to the end."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # the local part is the run before the at sign, cut where the previous address ended
    end = 0
    for m in AT.finditer(text):
        at = start = m.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            end = m.end()
            yield start, end


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def _base(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        for s, e in _emails(text):
            yield "email", s, e
    for m in IP.finditer(text):
        if all(map(_at_most_255, m[0].split("."))):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                yield "phone", m.start(), m.end()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    # capitals or digits behind an IBAN look like more of it: a known country's length is tried first, then the whole run, and
    # with other countries every end of a group, the longest first
    last = 0
    for m in IBAN.finditer(text):
        if m.start() < last:
            continue
        run = IBAN_REST.match(text, m.end()).end()
        ends, n = [], 4
        for at in range(m.end(), run):
            n += text[at] != " "
            if n >= 15 and text[at] != " " and not (text[at + 1 : at + 2].isascii() and text[at + 1 : at + 2].isalnum()):
                ends.append((at + 1, n))
        ends.reverse()
        if length := IBAN_LENGTH.get(m[0][:2]):
            ends = [e for e in ends if e[1] == length] + ends[:1]
        for end, _ in ends:
            if mod97(text[m.start() : end].replace(" ", "")):
                last = end
                yield m.start(), end
                break


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    # proposed by its context word: it starts at most CONTEXT_WIDTH behind the word, and ends where its run ends
    words = [c.end() for c in CONTEXT["secret"].finditer(text)]
    if not words:
        return
    runs = [(m.start(), m.end(), m.end() - 1 - d.start()) for m in SECRET.finditer(text) if (d := _DIGIT.search(m[0][::-1]))]
    first = 0
    for word in words:
        while first < len(runs) and runs[first][1] <= word:
            first += 1
        for start, end, digit in runs[first : first + 4]:  # no more runs of 24 can start within the width
            at = max(start, word)
            while start < at < end and at <= word + CONTEXT_WIDTH and text[at - 1].isascii() and text[at - 1].isalnum():
                at += 1
            if at > word + CONTEXT_WIDTH:
                break
            if end - at >= LEAST_SECRET and digit >= at:
                rest = SECRET_REST.match(text, end)
                yield at, rest.end() if rest else end
                break


def _added(text: str) -> Iterator[tuple[str, int, int]]:
    # a span of the first three kinds holds a digit itself, one of the last its opening letters
    if any(c in text for c in "0123456789"):
        for start, end in _ibans(text):
            yield "iban", start, end
        for m in SSN.finditer(text):
            yield "ssn", m.start(), m.end()
        for start, end in _secrets(text):
            yield "secret", start, end
    if "eyJ" in text:
        for m in JWT.finditer(text):
            yield "jwt", m.start(), m.end()


def find(text: str | None) -> list[Span]:
    """(kind, start, end, score) by kind as in KINDS, then start; code points, end exclusive."""
    if not text:
        return []
    out = dict.fromkeys(_base(text)) | dict.fromkeys(_added(text))
    spans = []
    for kind, start, end in out:
        before, behind = text[max(0, start - CONTEXT_WIDTH) : start], text[end : end + CONTEXT_BEHIND]
        score = SHAPE_SCORE[kind]
        if CONTEXT[kind].search(before) or CONTEXT[kind].search(behind):
            score += CONTEXT_BONUS
        if kind in CONTEXT_AGAINST and CONTEXT_AGAINST[kind].search(before):
            score -= CONTEXT_PENALTY
        score = min(1.0, score)
        if kind in BASE or score >= MIN_SCORE - 1e-9:
            spans.append((kind, start, end, score))
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by ``<KIND>``; spans that overlap become one, named after the first kind in KINDS."""
    if not spans:
        return text
    merged: list[list] = []
    for kind, start, end, _ in sorted(spans, key=lambda s: s[1]):
        rank = KINDS.index(kind)
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
            merged[-1][2] = min(merged[-1][2], rank)
        else:
            merged.append([start, end, rank])
    out, at = [], 0
    for start, end, rank in merged:
        out += [text[at:start], f"<{KINDS[rank].upper()}>"]
        at = end
    return "".join([*out, text[at:]])


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) for every row; spans: array of (kind, start, end, score)."""
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = kept.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, _SPAN)], ["id", "spans"])

    return over_texts(kept, run, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_col)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns of ``docs`` with personal data in the text masked and the length column, if there is one, made to fit.

    A null text stays null.
    """
    names = docs.columns
    text, changed = fresh("masked_text", names), fresh("was_masked", names)
    schema = docs.select("*", F.lit(None).cast("string").alias(text), F.lit(None).cast("boolean").alias(changed)).schema
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new, hit = [], []
            for t in b.column(at).to_pylist():
                spans = find(t)
                hit.append(bool(spans))
                new.append(mask(t, spans) if spans else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(new, pa.string()), pa.array(hit, pa.bool_())], [*names, text, changed])

    out = over_texts(docs, run, schema)
    cols: list[Column] = []
    for c in names:
        if c == text_col:
            cols.append(F.when(F.col(changed), F.col(text)).otherwise(F.col(c)).alias(c))
        elif c == length_col:
            cols.append(F.when(F.col(changed), F.length(text).cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(*cols)


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts of the base kinds, a digest of their spans, all spans as text."""
    found = detect(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

    def joined(only: Column | None) -> Column:
        spans = F.col("spans") if only is None else F.filter("spans", lambda s: s["kind"].isin(*BASE))
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(F.lit(True)), 256).alias("base_sha256"), joined(None).alias("spans"), F.array_join(F.transform("spans", lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"), *[count(k) for k in KINDS[4:]], F.size("spans").cast("long").alias("n_spans"))


def pii_base_counts(spark, sf_dir: str) -> DataFrame:
    """How often each base kind stands in every document."""
    found = detect(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in BASE])


#: The base kinds by the contract's patterns and checks.
BASE_COUNTS_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS email, regexp_extract_all(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') AS ip,
    list_transform(regexp_extract_all(t, '[0-9]([\x20-]?[0-9])+'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')) AS card,
    list_transform(regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g'))) AS phone
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
)
SELECT doc_id, len(email) AS n_email,
  len(list_filter(ip, lambda x: list_max(list_transform(string_split(x, '.'), lambda p: CAST(p AS DOUBLE))) <= 255)) AS n_ip,
  len(list_filter(card, lambda x: length(x) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(x) + 1), lambda i:
    CASE WHEN i % 2 = 1 THEN CAST(substr(x, length(x) - i + 1, 1) AS INTEGER) ELSE CAST(substr(x, length(x) - i + 1, 1) AS INTEGER) * 2 - 9 * (CAST(substr(x, length(x) - i + 1, 1) AS INTEGER) // 5) END)) % 10 = 0)) AS n_card,
  len(list_filter(phone, lambda n: n BETWEEN 9 AND 15)) AS n_phone
FROM d
"""
