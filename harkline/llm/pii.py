"""Personal data: patterns propose, checksums confirm, context words set the score.

Patterns propose spans, validators (Luhn for cards, mod 97 for IBANs, number ranges for
addresses) confirm or drop them, and words near a span raise or lower its score.

Base kinds (`email`, `ip`, `card`, `phone`) are kept whatever their score. The added kinds
are kept from a score of `MIN_SCORE` on. Strong ones stand without context and fall where
words such as `example` are near and none of their own:

* `iban`: confirmed by the mod-97 check; ends at its country's length, whatever capitals or
  digits follow;
* `key`: access keys and tokens known by their form (`AKIA...`, `ghp_...`, `sk-...`, `xoxb-...`,
  three-part web tokens), and private key blocks up to their last line, or their first line
  where the last is missing;
* `secret`: a value with a digit after a word such as `password` or `api-key`, in any case, and
  `=` or `:`, in quotes of either kind or bare; a value after `Bearer`; a quoted long hex value.

Weak ones are common forms of numbers that need a word of their own near, and that no other
span may overlap: `national_id` (3-2-4 digits in the ranges that are given out), `passport`
(one or two capitals and 6 to 8 digits), `account` (8 to 17 digits), `birth` (a date),
`local_phone` (3-3-4 digits without `+`).

Defined cases: a null text is an empty text and has no spans; positions count code points
and ends are exclusive; whole texts are searched; repeated rows give repeated results.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from harkline.llm.common import map_arrow, pieces, texts_of

#: The kinds in the order in which equal starts are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
STRONG_KINDS = ("iban", "key", "secret")
WEAK_KINDS = ("national_id", "passport", "birth", "local_phone", "account")
ADDED_KINDS = STRONG_KINDS + WEAK_KINDS
KINDS = BASE_KINDS + ADDED_KINDS

#: The base patterns. E-mail addresses,
#: `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+`, are searched for from each @ to both
#: sides. `[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)` cannot start inside a run of digits whose
#: start failed, so the look-behind only saves the second try on very long numbers.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Patterns of the added kinds.
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
IBAN_GROUP = re.compile(r"\x20?[A-Z0-9]{4}")
IBAN_TAIL = re.compile(r"\x20?[A-Z0-9]{1,3}(?![A-Za-z0-9])")
KEY = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,255}|github_pat_[A-Za-z0-9_]{22,255}"
    r"|sk-(?=[A-Za-z0-9_-]{0,200}[0-9])[A-Za-z0-9_-]{20,200}|xox[abprs]-[A-Za-z0-9-]{10,200}"
    r"|eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{4,}+\.[A-Za-z0-9_-]{8,}+)(?![A-Za-z0-9])"
)
#: What the text of a key holds, so that most texts are not searched.
KEY_MARKS = ("AKIA", "ASIA", "gh", "sk-", "xox", "eyJ")
BLOCK_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9]{1,20} ){0,3}PRIVATE KEY-----")
BLOCK_END = re.compile(r"-----END ([A-Z0-9]{1,20} ){0,3}PRIVATE KEY-----")
SECRET = re.compile(
    r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\x20?[=:]\x20?"
    r"(?:\"([^\"\s]{8,200})\"|'([^'\s]{8,200})'|([A-Za-z0-9+/_.~@!#$%^*-]{7,199}[A-Za-z0-9+/_=-]))"
    r"|\b(?i:bearer)\x20([A-Za-z0-9._~+/-]{15,}+=*)"
    r"|[\"']([0-9a-f]{32,}+)[\"']"
)
#: Patterns of the weak kinds.
NATIONAL_ID = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
PASSPORT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{1,2}[0-9]{6,8}(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"(?<![A-Za-z0-9.+-])[0-9]{8,17}(?![A-Za-z0-9-])(?!\.[0-9])")
BIRTH = re.compile(
    r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])"
    r"|(?:0?[1-9]|[12][0-9]|3[01])([./-])(?:0?[1-9]|[12][0-9]|3[01])\1(?:19|20)[0-9]{2})(?![0-9/-])"
)
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")
WEAK = (("national_id", NATIONAL_ID), ("passport", PASSPORT), ("birth", BIRTH), ("local_phone", LOCAL_PHONE), ("account", ACCOUNT))

#: Characters of an IBAN by country.
IBAN_LENGTH = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
    }.items()
    for country in countries.split()
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")

#: Score of a confirmed span without context, by kind.
START_SCORE = {
    "email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "key": 0.8, "secret": 0.6,
    "national_id": 0.4, "passport": 0.35, "birth": 0.35, "local_phone": 0.4, "account": 0.35,
}
#: Words that raise a kind's score when they stand within CONTEXT code points of a span.
RAISE = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "fax", "mobile"),
    "iban": ("iban", "account", "bank", "transfer"),
    "key": ("key", "access", "aws", "token", "bearer", "authorization"),
    "secret": ("password", "passwd", "pwd", "secret", "token", "api", "key", "bearer"),
    "national_id": ("ssn", "social", "taxpayer", "tin"),
    "passport": ("passport",),
    "birth": ("born", "birth", "birthday", "birthdate", "dob"),
    "local_phone": ("phone", "telephone", "call", "tel", "fax", "mobile", "cell"),
    "account": ("account", "acct", "iban", "routing", "konto", "bank"),
}
#: Words that lower every score by much, and words that lower it by little where none of its own is nearer.
DOUBT = ("example", "sample", "dummy", "fake", "placeholder")
LOWER = ("version", "build", "isbn", "order", "invoice", "serial")
CONTEXT = 40
STEP = 0.2
DOUBT_STEP = 0.4
MIN_SCORE = 0.5

_WORD = re.compile(r"[a-z]+")


class Stretches:
    """Stretches of a text that are taken; the first ones may overlap."""

    def __init__(self, spans: list[Span]):
        self._starts, self._ends = [], []
        for span in sorted(spans, key=lambda s: s.start):
            if self._ends and span.start < self._ends[-1]:
                self._ends[-1] = max(self._ends[-1], span.end)
            else:
                self._starts.append(span.start)
                self._ends.append(span.end)

    def add(self, start: int, end: int) -> bool:
        """Take a stretch if nothing of it is taken."""
        at = bisect.bisect_left(self._starts, end)
        if at and self._ends[at - 1] > start:
            return False
        self._starts.insert(at, start)
        self._ends.insert(at, end)
        return True


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Luhn check: every second digit from the right doubled, digit sums added, multiple of ten."""
    total = 0
    for place, d in enumerate(reversed(digits)):
        value = ord(d) - 48
        if place & 1:
            value = 2 * value - 9 if value > 4 else 2 * value
        total += value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Country and check digits moved to the end, letters as 10 to 35, remainder 1 by 97."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: each @ has one longest local part and one domain."""
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1)
        if begin < at and domain:
            yield begin, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each base kind, without those that fail their check."""
    found = []
    if "@" in text:
        found += [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return found
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def _iban_ends(text: str, start: int) -> list[int]:
    """Ends of 2 to 7 groups of four after the first four characters, each also with a tail, longest first."""
    ends, at = [], start + 4
    for groups in range(8):
        tail = IBAN_TAIL.match(text, at)
        if groups >= 2:
            if at == len(text) or not (text[at].isascii() and text[at].isalnum()):
                ends.append(at)
            if tail:
                ends.append(tail.end())
        group = IBAN_GROUP.match(text, at)
        if not group:
            break
        at = group.end()
    return ends[::-1]


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping spans that hold by mod 97.

    What follows an IBAN can look like more of it: the country's length comes first, then the
    longest end, then, for a country of unknown length, the shorter ones.
    """
    done = 0
    for m in IBAN_START.finditer(text):
        if m.start() < done:
            continue
        length, ends = IBAN_LENGTH.get(m[0][:2]), _iban_ends(text, m.start())
        right = [e for e in ends if len(text[m.start():e].replace(" ", "")) == length]
        for end in right + (ends[:1] if length else ends):
            if mod97(text[m.start():end].replace(" ", "")):
                yield m.start(), end
                done = end
                break


def _key_blocks(text: str) -> Iterator[tuple[int, int]]:
    """Private key blocks; one without its last line before the next first line is that first line only."""
    begin = BLOCK_BEGIN.search(text)
    while begin:
        after = BLOCK_BEGIN.search(text, begin.end())
        last = BLOCK_END.search(text, begin.end(), after.start() if after else len(text))
        yield begin.start(), (last or begin).end()
        begin = after


def strong_spans(text: str) -> list[tuple[str, int, int]]:
    """Confirmed candidates of the kinds that stand without context."""
    found = []
    if any(mark in text for mark in KEY_MARKS):
        found += [("key", *m.span()) for m in KEY.finditer(text)]
    if "-----BEGIN" in text:
        found += [("key", a, b) for a, b in _key_blocks(text)]
    if not _DIGIT.search(text):
        return found
    found += [("iban", a, b) for a, b in ibans(text)]
    keys = {(a, b) for _, a, b in found}
    for m in SECRET.finditer(text):
        group = m.lastindex
        if _DIGIT.search(m[group]) and m.span(group) not in keys:
            found.append(("secret", *m.span(group)))
    return found


def weak_spans(text: str) -> list[tuple[str, int, int]]:
    """Candidates of the kinds that need context."""
    if not _DIGIT.search(text):
        return []
    return [(kind, *m.span()) for kind, pattern in WEAK for m in pattern.finditer(text)]


def score(text: str, kind: str, start: int, end: int) -> float:
    """Start score of the kind, a step up or down for context words around the span.

    Of the kind's own words and those that lower by little the nearest decides.
    """
    before, after = text[max(0, start - CONTEXT):start].lower(), text[end:end + CONTEXT].lower()
    near = {}
    for word, away in [(m[0], len(before) - m.end()) for m in _WORD.finditer(before)] + [(m[0], m.start()) for m in _WORD.finditer(after)]:
        near[word] = min(away, near.get(word, CONTEXT))
    own = min((near[w] for w in RAISE[kind] if w in near), default=None)
    other = min((near[w] for w in LOWER if w in near), default=None)
    value = START_SCORE[kind]
    if own is not None and (other is None or own <= other):
        value += STEP
    elif other is not None:
        value -= STEP
    value -= DOUBT_STEP * any(w in near for w in DOUBT)
    return round(min(1.0, max(0.0, value)), 2)


def find(text: str) -> list[Span]:
    """All spans of a text by start, then kind as listed."""
    spans = [Span(k, a, b, score(text, k, a, b)) for k, a, b in base_spans(text)]
    for kind, a, b in strong_spans(text):
        value = score(text, kind, a, b)
        if value >= MIN_SCORE:
            spans.append(Span(kind, a, b, value))
    weak = [Span(k, a, b, score(text, k, a, b)) for k, a, b in weak_spans(text)]
    weak = sorted((s for s in weak if s.score >= MIN_SCORE), key=lambda s: -s.score)
    if weak:
        taken = Stretches(spans)
        spans += [s for s in weak if taken.add(s.start, s.end)]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(spans, key=lambda s: (s.start, order[s.kind]))


def redact(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of its first span."""
    out, done = [], 0
    for span in spans:
        if span.start >= done:
            out += [text[done:span.start], f"<{span.kind.upper()}>"]
        done = max(done, span.end)
    return "".join(out) + text[done:]


_SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key and `spans`, an array of (kind, start, end, score)."""
    source = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    schema = T.StructType([T.StructField("key", source.schema["key"].dataType), T.StructField("spans", T.ArrayType(_SPAN))])
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            spans = [[s._asdict() for s in find(t)] for t in texts_of(piece["text"])]
            yield pa.RecordBatch.from_arrays([piece["key"], pa.array(spans, kind)], ["key", "spans"])

    return map_arrow(source, run, schema).withColumnRenamed("key", key)


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans and all spans as text, per document."""
    source = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    schema = T.StructType(
        [T.StructField("doc_id", source.schema["doc_id"].dataType)]
        + [T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS]
        + [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans")]
        + [T.StructField("min_score", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            counts = {k: np.zeros(piece.num_rows, dtype=np.int64) for k in BASE_KINDS}
            digests, listed, lowest = [], [], []
            for row, t in enumerate(texts_of(piece["text"])):
                spans = find(t)
                told = [f"{s.kind}:{s.start}:{s.end}" for s in spans]
                base = [x for s, x in zip(spans, told) if s.kind in counts]
                for s in spans:
                    if s.kind in counts:
                        counts[s.kind][row] += 1
                digests.append(hashlib.sha256(",".join(base).encode()).hexdigest())
                listed.append(",".join(told))
                lowest.append(min((s.score for s in spans), default=None))
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], *(pa.array(c) for c in counts.values()), pa.array(digests, pa.string()),
                 pa.array(listed, pa.string()), pa.array(lowest, pa.float64())],
                schema.names,
            )

    return map_arrow(source, run, schema)


def redact_documents(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The same rows and columns with personal data replaced by its kind; `length` follows the text.

    A null text stays null; a null text keeps its length.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at, size = docs.columns.index(text), docs.columns.index(length) if length in docs.columns else None
    source = docs.toDF(*names)
    schema = source.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, names[at]):
            columns = list(piece.columns)
            new = [None if t is None else redact(t, find(t)) for t in columns[at].to_pylist()]
            columns[at] = pa.array(new, columns[at].type)
            if size is not None:
                kept = columns[size].to_pylist()
                columns[size] = pa.array([k if t is None else len(t) for k, t in zip(kept, new)], columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(source, run, schema).toDF(*docs.columns)
