"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the few places where personal data can be: at-signs, schemes
(``://``), plus-signs, digits and identifier cues (``iban``, ``account`` ...). A deterministic
parser then expands each anchor to the run of characters its kind may hold and validates what it
finds there. Text without anchors is passed over by the automaton alone.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are exactly the leftmost non-overlapping matches
of their patterns over the whole text that pass their check. This holds because a match never
leaves the run of its kind's characters, so matching inside each run gives what matching over the
text gives. Kinds ``url`` (a URL with user information or a query that names personal data) and
``account`` (an identifier behind a cue) are added by the method.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, strings

#: Kinds in the order of their spans. The first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]

# The patterns of the base kinds.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
# The parts that the local parsers of these two put together in one pass.
_AFTER_AT = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Words that announce an identifier.
CUES = ("account", "acct", "iban", "passport", "ssn", "customer id", "user id", "member id",
        "konto", "compte", "cuenta")
_DOTTED = re.compile(r"[0-9.]*")
_SPACED = re.compile(r"[0-9\x20-]*")
_DIALLED = re.compile(r"[\x20().0-9+-]*")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*\Z")
_URL = re.compile(r"[^\s<>\"]*")
_IDENTIFIER = re.compile(r"\s{0,3}(?:no\.?|number|nr\.?|id)?\s{0,3}[:#=]\s{0,3}([A-Za-z0-9][A-Za-z0-9-]*)",
                         re.IGNORECASE)
# Between a cue and a value that proves itself, so that no separator is needed.
_LEAD = re.compile(r"\s{0,3}(?:(?:no\.?|number|nr\.?|id)(?![A-Za-z0-9]))?\s{0,3}[:#=]?\s{0,3}", re.IGNORECASE)
# In one piece, or printed in groups of four.
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[A-Za-z0-9]{11,30}(?![A-Za-z0-9])"
                   r"|(?:[\x20-][A-Za-z0-9]{4}){2,7}(?:[\x20-][A-Za-z0-9]{1,3})?(?![A-Za-z0-9]))")
_SSN = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![A-Za-z0-9-])")
#: Length of an IBAN by country.
_IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 "
    "EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 "
    "KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 "
    "PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 "
    "VG24 XK20").split()}
_HOST = re.compile(r"[^/?#]*")
_PRIVATE_QUERY = re.compile(r"(?=[?&;](?:e?mail|phone|user|token|ssn)=[^&#;])", re.IGNORECASE)

Span = tuple[int, int, int]  # kind number, start, end (code points, end exclusive)


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for mark in ("@", "://", "+", *"0123456789"):
        found.add_word(mark, mark if len(mark) == 1 else "://")
    for cue in CUES:
        found.add_word(cue, "cue")
    found.make_automaton()
    return found


_LOWER = {c: c + 32 for c in range(65, 91)}


def _folded(text: str) -> str:
    """``text`` in lower case, character for character: the automaton is exact."""
    low = text.lower()
    # Few capitals become two characters.
    return low if len(low) == len(text) else text.translate(_LOWER)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _iban_end(text: str, at: int) -> int | None:
    """End of the valid IBAN at ``at``. Words behind one in groups may look like groups of it."""
    m = _IBAN.match(text, at)
    if not m:
        return None
    end = m.end()
    while end > at:
        value = text[at:end].replace(" ", "").replace("-", "").upper()
        if _IBAN_LENGTHS.get(value[:2], len(value)) == len(value) >= 15 and int(
                "".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1:
            return end
        end = max(text.rfind(" ", at, end), text.rfind("-", at, end))
    return None


def _valid_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _valid_card(text: str) -> bool:
    digits = text.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def _valid_phone(text: str) -> bool:
    return 8 <= sum(c.isdigit() for c in text) <= 15


def _back(text: str, at: int, allowed: frozenset, low: int) -> int:
    """First position of the run of ``allowed`` characters that ends before ``at``."""
    while at > low and text[at - 1] in allowed:
        at -= 1
    return at


_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED_SET = frozenset("0123456789.")
_SPACED_SET = frozenset("0123456789 -")
_SCHEME_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")


class Finder:
    """Spans of one text at a time."""

    def __init__(self) -> None:
        self.automaton = _automaton()

    def __call__(self, text: str) -> list[Span]:
        spans: list[Span] = []
        ip_end = card_end = phone_end = 0  # ends of the runs already parsed
        ends = 0  # end of the last e-mail match: the next one starts at it or later
        url = (0, 0, 0)
        for at, mark in self.automaton.iter(_folded(text)):
            if mark == "@":
                ends = self._email(text, at, ends, spans)
            elif mark == "+":
                if at >= phone_end:
                    phone_end = _DIALLED.match(text, at).end()
                    self._matches(text, PHONE, 3, _valid_phone, at, phone_end, spans)
            elif mark == "cue":
                self._account(text, at + 1, spans)
            elif mark == "://":
                url = self._url(text, at - 2, url, spans)
            else:
                if at >= ip_end:
                    ip_end = _DOTTED.match(text, at).end()
                    self._addresses(text, at, ip_end, spans)
                if at >= card_end:
                    card_end = _SPACED.match(text, at).end()
                    self._matches(text, CARD, 2, _valid_card, at, card_end, spans)
        return self._merge(spans)

    @staticmethod
    def _matches(text, pattern, kind, valid, start, end, spans) -> None:
        # The run starts at its first digit (or plus): earlier characters begin no match.
        for m in pattern.finditer(text, start, end):
            if valid(m.group()):
                spans.append((kind, m.start(), m.end()))

    @staticmethod
    def _addresses(text: str, start: int, end: int, spans: list[Span]) -> None:
        """Four groups of digits with one dot between them, in a run of digits and dots: a match
        begins and ends with a whole group."""
        held: list[tuple[int, int]] = []
        for m in _DIGITS.finditer(text, start, end):
            if held and m.start() != held[-1][1] + 1:
                held = []
            held.append(m.span())
            if len(held) == 4:
                if _valid_ip(text[held[0][0]:m.end()]):
                    spans.append((1, held[0][0], m.end()))
                held = []

    @staticmethod
    def _email(text: str, at: int, ends: int, spans: list[Span]) -> int:
        """The e-mail around the at-sign ``at``, if any; where the last one ends. The local part
        goes back to the at-sign before at most, the domain on to the next, so no character is read
        more than twice."""
        start = _back(text, at, _LOCAL_SET, ends) if at >= ends else at
        m = _AFTER_AT.match(text, at + 1) if start < at else None
        if not m:
            return ends
        spans.append((0, start, m.end()))
        return m.end()

    @staticmethod
    def _url(text: str, at: int, run: tuple[int, int, int], spans: list[Span]) -> tuple[int, int, int]:
        """The URL whose scheme ends at ``at``, if it is private. ``run``: end of the run of URL
        characters read last, its end without closing punctuation, and the last place in it where
        a private query begins; found once for all schemes in a run."""
        scheme = _back(text, at, _SCHEME_SET, max(0, at - 16))
        m = _SCHEME.match(text, scheme, at)
        if not m:
            return run
        if at >= run[0]:
            whole = end = _URL.match(text, at + 3).end()
            while end > at + 3 and text[end - 1] in ".,;:!?)]'":
                end -= 1
            last = max((q.start() for q in _PRIVATE_QUERY.finditer(text, at + 3, end)), default=-1)
            run = (whole, end, last)
        end = max(run[1], at + 3)
        host_end = _HOST.match(text, at + 3, end).end()
        if text.find("@", at + 3, host_end) >= 0 or run[2] >= at + 3:
            spans.append((4, scheme, end))
        return run

    @staticmethod
    def _account(text: str, at: int, spans: list[Span]) -> None:
        start, end = _LEAD.match(text, at).end(), 0
        if not text[start - 1].isalnum():
            ssn = _SSN.match(text, start)
            end = ssn.end() if ssn else _iban_end(text, start) or 0
        m = _IDENTIFIER.match(text, at)
        if m:
            value = m.group(1)
            digits = sum(c.isdigit() and c.isascii() for c in value)
            if 6 <= len(value) <= 40 and digits >= 4 and m.end(1) > end:
                start, end = m.span(1)
        if end:
            spans.append((5, start, end))

    @staticmethod
    def _merge(spans: list[Span]) -> list[Span]:
        """By kind, then start; an added kind keeps no span twice."""
        return sorted(set(spans))


def base_digest(spans: list[Span]) -> tuple[str, str]:
    """SHA-256 of the base spans' list, and the list of all spans."""
    shown = [f"{KINDS[k]}:{a}:{b}" for k, a, b in spans]
    base = ",".join(s for s, (k, _, _) in zip(shown, spans, strict=True) if k < len(BASE))
    return hashlib.sha256(base.encode()).hexdigest(), ",".join(shown)


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one,
    named by the earliest (the longest of those)."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a < at:
            if b > at:
                at = b
            continue
        out.append(text[at:a])
        out.append(f"[{KINDS[k].upper()}]")
        at = b
    out.append(text[at:])
    return "".join(out)


_FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _per_text(make, returns: str):
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = Finder()
        for column in columns:
            parts = []
            for s in slices([pa.RecordBatch.from_arrays([column], ["t"])], 2_000, "t"):
                parts.append(make(finder, s.column(0)))
            yield pa.concat_arrays(parts) if parts else make(finder, column)
    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returns)


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of the base kinds, the digest of the base spans and all spans.

    Whole texts are searched; a null text counts as empty (no spans; the digest is that of the
    empty string). Every row is answered by itself: repeated rows repeat, an empty table gives no
    rows. Columns of ``docs`` with the names of the result are replaced.
    """
    def make(finder, column):
        rows = []
        for t in strings(column):
            spans = finder(t)
            counts = [0] * len(KINDS)
            for k, _, _ in spans:
                counts[k] += 1
            digest, shown = base_digest(spans)
            rows.append((*counts[:4], digest, shown))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        arrays = [pa.array(c, pa.int64()) for c in cols[:4]]
        arrays += [pa.array(c, pa.string()) for c in cols[4:]]
        return pa.StructArray.from_arrays(arrays, [f.split()[0] for f in _FOUND.split(", ")])

    names = [f.split()[0] for f in _FOUND.split(", ")]
    found = _per_text(make, _FOUND)
    kept = [c for c in docs.columns if c not in names]
    with_found = docs.select(*kept, found(F.col("text").cast("string")).alias("_pii"))
    return with_found.select(*kept, *[F.col(f"_pii.{n}").alias(n) for n in names])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans in ``text`` replaced by their kinds; a null text stays null. Where
    ``docs`` has ``n_chars`` it is counted anew for the texts that changed."""
    def make(finder, column):
        return pa.array([None if t is None else redact(t, finder(t)) for t in column.to_pylist()],
                        pa.string())

    clean = _per_text(make, "string")
    out = docs.select(F.struct(*docs.columns).alias("_row"), clean(F.col("text").cast("string")).alias("_clean"))
    changed = F.col("_clean") != F.col("_row.text")

    def column(name: str):
        if name == "text":
            return F.col("_clean").alias(name)
        if name == "n_chars":
            count = F.char_length("_clean").cast(docs.schema[name].dataType)
            return F.when(changed, count).otherwise(F.col("_row.n_chars")).alias(name)
        return F.col("_row").getField(name).alias(name)

    return out.select(*[column(c) for c in docs.columns])
