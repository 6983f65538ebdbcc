"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, schemes,
digits and identifier cues. Local parsers then expand each anchor to the left and
right and validate what they find, without looking at the rest of the text.

Base kinds (leftmost, non-overlapping within a kind; a match that fails its check
is dropped and its characters are used up):

* ``email``  local part, at-sign, host labels joined by dots
* ``ip``     four numbers joined by dots, each at most 255
* ``card``   14 to 19 digits with single spaces or hyphens between, passing Luhn
* ``phone``  plus sign, 10 to 15 digits with spaces, dots, brackets, hyphens

Added kinds: ``url`` (scheme and authority up to a space or quote), ``secret``
(a cue such as ``token =`` and a quoted or bare value of 16 or more word
characters with a digit), ``iban`` (country letters and two digits, with or without a
cue, of the country's length and passing mod 97; after a cue also all that follows, and
where the country has no known length the longest end that passes). Schemes and cues match in any case.

Offsets are code points, ends exclusive. Null text counts as empty.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SCHEMES = ("http://", "https://", "ftp://", "ssh://")
CUES = ("token", "api_key", "apikey", "secret", "password", "passwd")
IBAN_CUE = "iban"
# Length of an IBAN by country.
_LENGTHS = (
    "NO15 BE16 BI27 DK18 FI18 FK18 FO18 GL18 NL18 SD18 MK19 SI19 AT20 BA20 EE20 KZ20 LT20 LU20 MN20 XK20 CH21 HR21 LI21 LV21 BG22 BH22 CR22 DE22 GB22 GE22 IE22 ME22 RS22 VA22 "
    "AE23 GI23 IL23 IQ23 OM23 SO23 TL23 AD24 CZ24 ES24 MD24 PK24 RO24 SA24 SE24 SK24 TN24 VG24 LY25 PT25 ST25 IS26 TR26 DJ27 FR27 GR27 IT27 MC27 MR27 SM27 "
    "AL28 AZ28 BY28 CY28 DO28 GT28 HN28 HU28 LB28 NI28 PL28 SV28 BR29 EG29 PS29 QA29 UA29 JO30 KW30 MU30 YE30 MT31 SC31 LC32 RU33"
)
IBAN_LENGTHS = {x[:2]: int(x[2:]) for x in _LENGTHS.split()}
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DIGITS = frozenset("0123456789")
_CAPITALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PHONE = re.compile(r"[0-9][\x20().0-9-]+[0-9]")
_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_DOTTED = re.compile(r"[0-9]+")
_URL = re.compile(r"[^\s\"'<>]+")
_SECRET = re.compile(r"[\x20]{0,3}[=:][\x20]{0,3}[\"']?([A-Za-z0-9_\-]{16,})")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_AFTER_CUE = re.compile(r"[\x20:]{0,3}(?=[A-Z]{2}[0-9]{2})")
_CASES = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    text = text.replace(" ", "")
    turned = text[4:] + text[:4]
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def iban_end(text: str, at: int, cued: bool) -> int:
    """Where the IBAN that begins at this place ends, or 0."""
    m = _IBAN.match(text, at)
    if not m:
        return 0
    places = [i for i in range(at, m.end()) if text[i] != " "]
    known = IBAN_LENGTHS.get(m[0][:2])
    if known is None and not cued:
        return 0
    for n in range(len(places), 14, -1) if known is None else (known, len(places)) if cued else (known,):
        end = places[n - 1] + 1 if n <= len(places) else 0
        whole = end and (cued or text[end : end + 1] not in _WORD)
        if whole and iban_valid(text[at:end]):
            return end
    return 0


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    a.add_word("@", ("email", 1))
    a.add_word("+", ("phone", 1))
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
    for s in SCHEMES:
        a.add_word(s, ("url", len(s)))
    for c in CUES:
        a.add_word(c, ("secret", len(c)))
    a.add_word(IBAN_CUE, ("iban", len(IBAN_CUE)))
    a.make_automaton()
    return a


class Finder:
    def __init__(self):
        self.anchors = automaton()

    def spans(self, text: str) -> list[tuple[int, str, int]]:
        """(start, kind, end), by start, then kind in the order of KINDS and the added ones."""
        found: list[tuple[int, str, int]] = []
        email_to = quad_to = run_to = phone_to = url_to = digit_to = 0
        lower = text.lower()
        if len(lower) != len(text):  # offsets must stay
            lower = text.translate(_CASES)
        for last, (kind, size) in self.anchors.iter(lower):
            at = last + 1 - size
            if kind == "digit":
                if at < digit_to:
                    continue
                # first digit of a run; the parsers read on from here
                digit_to = _DOTTED.match(text, at).end()
                if digit_to >= at + 2 and at >= 2 and text[at - 2] in _CAPITALS and text[at - 1] in _CAPITALS and text[at - 3 : at - 2] not in _WORD:
                    if end := iban_end(text, at - 2, False):
                        found.append((at - 2, "iban", end))
                if at >= quad_to and text[digit_to : digit_to + 1] == "." and (m := _QUAD.match(text, at)):
                    quad_to = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                        found.append((at, "ip", quad_to))
                if at >= run_to and (m := _RUN.match(text, at)):
                    run_to = m.end()
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        found.append((at, "card", run_to))
            elif kind == "email":
                start = at
                while start > email_to and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at and (m := _HOST.match(text, at + 1)):
                    email_to = m.end()
                    found.append((start, "email", email_to))
            elif kind == "phone":
                if at >= phone_to and (m := _PHONE.match(text, at + 1)):
                    phone_to = m.end()
                    if 10 <= sum(c in _DIGITS for c in m[0]) <= 15:
                        found.append((at, "phone", phone_to))
            elif kind == "url":
                if at >= url_to and (m := _URL.match(text, last + 1)):
                    url_to = m.end()
                    found.append((at, "url", url_to))
            elif kind == "secret":
                if (m := _SECRET.match(text, last + 1)) and any(c in _DIGITS for c in m[1]):
                    found.append((m.start(1), "secret", m.end(1)))
            elif (m := _AFTER_CUE.match(text, last + 1)) and (end := iban_end(text, m.end(), True)):
                found.append((m.end(), "iban", end))
        order = {k: i for i, k in enumerate((*KINDS, "url", "secret", "iban"))}
        return sorted(set(found), key=lambda s: (s[0], order[s[1]], s[2]))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_<base kind>, base_sha256, spans, n_added."""
    finder: list[Finder] = []

    def scan(batches):
        for batch in batches:
            if not finder:
                finder.append(Finder())
            counts: dict[str, list[int]] = {k: [] for k in KINDS}
            shas, joined, added = [], [], []
            for text in batch.column(1).to_pylist():
                got = finder[0].spans(text or "")
                base = [s for s in got if s[1] in KINDS]
                for k in KINDS:
                    counts[k].append(sum(s[1] == k for s in base))
                shas.append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in base).encode()).hexdigest())
                joined.append(",".join(f"{k}:{a}:{b}" for a, k, b in got))
                added.append(len(got) - len(base))
            yield pa.record_batch(
                [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(shas, pa.string()), pa.array(joined, pa.string()), pa.array(added, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
