"""Personal data by anchor expansion.

One Aho-Corasick pass over the whole text finds at-signs, schemes, colons and identifier cues (credential names, key
prefixes, pairs of digits and digits before a dot).  From each anchor a deterministic local parser expands to the
boundaries and validates: emails by their grammar, addresses (IPv4 by octets, IPv6 by its grammar and at least three
groups, URLs with credentials), accounts (cards of 13 to 19 digits by the Luhn sum at every admissible length, where those written as cards
usually are go before other readings of the same digits, IBANs
by their country's length and mod 97, phones by form and 7 to 15 digits, secrets by their value).  Findings that
overlap are one finding: it covers all of them and has the kind of the longest, so nothing that any parser
accepts stays in the text.  What is found is replaced by its kind.

Null and empty texts stay as they are and have no findings; repeated rows have theirs each.  Texts are read whole, in
linear time, whatever their length: digits are read once for each group in which a number may begin.  Ties in length go to the kind
that comes first in ``KINDS``.

Not sought: names, postal addresses, dates of birth, phones without a country code other than ddd-ddd-dddd and
(ddd) ddd-dddd, obfuscated emails ("a at b dot de"), IPv6 of fewer than three groups.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_right

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, fresh
from .hashing import ranges

KINDS = ("URL", "EMAIL", "IBAN", "CARD", "PHONE", "SSN", "IP", "KEY", "SECRET")
PASSWORDS = ("password", "passwd", "pwd")
CUES = (*PASSWORDS, "token", "secret", "api_key", "apikey", "api-key", "access_key", "private_key")
#: What may follow "password:" in prose and forms without being one.
NO_PASSWORDS = frozenset("required optional none null true false string text hidden incorrect invalid missing wrong empty forgotten changed reset protected unknown your enter forgot confirm field".split())
IBAN_LENGTHS = dict(x.split(":") for x in "AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BR:29 BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 DK:18 DO:28 EE:20 EG:29 ES:24 FI:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HR:21 HU:28 IE:22 IL:23 IQ:23 IS:26 IT:27 JO:30 KW:30 KZ:20 LB:28 LC:32 LI:21 LT:20 LU:20 LV:21 LY:25 MC:27 MD:24 ME:22 MK:19 MR:27 MT:31 MU:30 NL:18 NO:15 PK:24 PL:28 PS:29 PT:25 QA:29 RO:24 RS:22 SA:24 SC:31 SD:18 SE:24 SI:19 SK:24 SM:27 ST:25 SV:28 TL:23 TN:24 TR:26 UA:29 VA:22 VG:24 XK:20".split())

_RUN = re.compile(r"[0-9.+() \t-]+")
_LEFT = frozenset("0123456789.+()- \t")
_BEGIN = re.compile(r"(?<!\d)[\d+(]")
_GROUP = re.compile(r"\d+")
_IP = re.compile(r"(?<![^\W_])(?<!\d\.)(?:\d{1,3}\.){3}\d{1,3}(?!\.\d)(?![^\W_])")
_WRITTEN = re.compile(r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{4,5}")
_SSN = re.compile(r"(?<![^\W_])(?<!\d-)\d{3}-\d{2}-\d{4}(?!-?\d)(?![^\W_])")
_PHONE = re.compile(r"(?<![^\W_])(?:\(\d{3}\) ?\d{3}[ -]\d{4}|\d{3}[-.]\d{3}[-.]\d{4})(?![^\W_])")
_ABROAD = re.compile(r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}")
_VALUE = re.compile(r"""["']?\s{0,3}[=:]\s{0,3}["']?([A-Za-z0-9_\-./+=]{6,})""")
_PASSWORD = re.compile(r"""["']?\s{0,3}([=:])\s{0,3}["']?([^\s"'<>,;&]{4,})""")
_AKIA = re.compile(r"AKIA[A-Z0-9]{16}(?![^\W_])")
_URL = re.compile(r"://[^\s/?#@\"'<>:]+:[^\s/?#@\"'<>]*@[^\s\"'<>]+")
_LABEL = r"[^\W_](?:(?:[^\W_]|-)*[^\W_])?"
_DOMAIN = re.compile(rf"(?:{_LABEL}\.)+(?:xn--[a-z0-9-]*[a-z0-9]|[^\W\d_]{{2,63}})")
_HEX = frozenset("0123456789abcdefABCDEF:.")
_LOCAL = frozenset("._%+-")


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word in CUES:
        for form in {word, word.upper(), word.capitalize()}:
            a.add_word(form, ("password" if word in PASSWORDS else "cue", len(form)))
    for i in range(100):
        a.add_word(f"{i:02}", ("digits", 2))
    for i in range(10):
        a.add_word(f"{i}.", ("digits", 2))
    a.add_word("@", ("@", 1))
    a.add_word("://", ("://", 3))
    a.add_word(":", (":", 1))
    a.add_word("AKIA", ("AKIA", 4))
    a.make_automaton()
    return a


_anchors: list = []


def _luhn(digits: str) -> bool:
    d = [int(x) for x in reversed(digits)]
    return sum(d[::2]) % 10 == -sum(x * 2 - 9 * (x > 4) for x in d[1::2]) % 10 and len(set(d)) > 1


def _edge(text: str, lo: int, hi: int) -> bool:
    return (not lo or not text[lo - 1].isalnum()) and (hi == len(text) or not text[hi].isalnum())


def _iban(text: str, lo: int) -> int | None:
    """The end of an IBAN from ``lo``: as many letters and digits as its country's have, in groups with single blanks or without."""
    head = text[lo : lo + 2]
    if not (head.isascii() and head.isalpha() and head.isupper()) or (lo and text[lo - 1].isalnum()):
        return None
    lengths = [int(IBAN_LENGTHS[head])] if head in IBAN_LENGTHS else range(34, 14, -1)
    chars, ends, at = [], {}, lo
    while at < len(text) and len(chars) < lengths[0]:
        c = text[at]
        if c == " " and chars and text[at - 1] != " ":
            at += 1
            continue
        if not (c.isascii() and (c.isdigit() or c.isupper())):
            break
        chars.append(c)
        at += 1
        ends[len(chars)] = at
    for n in lengths:
        if n in ends and _edge(text, lo, ends[n]) and int("".join(str(int(c, 36)) for c in chars[4:n] + chars[:4])) % 97 == 1:
            return ends[n]
    return None


def _email(text: str, at: int) -> tuple[int, int] | None:
    lo = at
    while lo and (text[lo - 1].isalnum() or text[lo - 1] in _LOCAL) and text[lo - 1 : lo + 1] != "..":
        lo -= 1
    while lo < at and text[lo] in _LOCAL:
        lo += 1
    m = _DOMAIN.match(text, at + 1)
    return None if lo == at or text[at - 1] == "." or not m else (lo, m.end())


def _cards(text: str, lo: int, to: int) -> list[int]:
    """All ends, at a separator's or the run's, with which the 13 to 19 digits from ``lo`` are a valid card."""
    digits, at, ends = "", lo, []
    while m := _GROUP.match(text, at, to):
        digits += m[0]
        if len(digits) > 19:
            break
        if len(digits) >= 13 and _edge(text, lo, m.end()) and _luhn(digits):
            ends.append(m.end())
        at = m.end() + (text[m.end() : m.end() + 1] in (" ", "-"))
    return ends


def _usual(text: str, cards: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The cards written as cards are, and the others that overlap none of these."""
    good = [c for c in cards if _WRITTEN.fullmatch(text, *c)]
    if len(good) == len(cards):
        return cards
    joined: list[list[int]] = []
    for a, b in sorted(good):
        if joined and a < joined[-1][1]:
            joined[-1][1] = max(b, joined[-1][1])
        else:
            joined.append([a, b])
    ends = [b for _, b in joined]
    free = lambda a, b: (i := bisect_right(ends, a)) == len(joined) or joined[i][0] >= b
    return good + [c for c in cards if free(*c)]


def _abroad(text: str, lo: int, to: int) -> int | None:
    """The greatest end with which what follows a plus sign is a phone number of 7 to 15 digits."""
    n, ends, at = 0, [], lo + 1
    while at < to and n <= 15:
        if text[at].isdigit():
            n += 1
            if n >= 7 and (at + 1 == len(text) or not text[at + 1].isalnum()):
                ends.append((n, at + 1))
        elif text[at] not in " .-()":
            break
        at += 1
    for n, end in reversed(ends):
        if n <= 15 and _edge(text, lo, end) and _ABROAD.fullmatch(text, lo, end):
            return end
    return None


def _numbers(text: str, start: int, to: int) -> list[tuple[str, int, int]]:
    """All numbers of the run of digits, signs and blanks, from every place where one may begin."""
    found, cards = [], []
    for m in _BEGIN.finditer(text, start, to):
        a = m.start()
        if text[a] == "+":
            if end := _abroad(text, a, to):
                found.append(("PHONE", a, end))
            continue
        for kind, pattern in (("IP", _IP), ("SSN", _SSN), ("PHONE", _PHONE)):
            if (x := pattern.match(text, a)) and (kind != "IP" or all(int(o) < 256 for o in x[0].split("."))):
                found.append((kind, a, x.end()))
        if text[a] != "(":
            cards += [(a, end) for end in _cards(text, a, to)]
    return found + [("CARD", *c) for c in (_usual(text, cards) if cards else ())]


def _address(text: str, at: int) -> tuple[int, int, int]:
    """The run of hexadecimal digits, colons and dots around ``at``, without dots and a single colon at its end; and where the run ends.  The
    first two are equal if it isn't an IPv6 address."""
    lo = at
    while lo and text[lo - 1] in _HEX:
        lo -= 1
    end = at
    while end < len(text) and text[end] in _HEX:
        end += 1
    hi = end
    while hi > lo and (text[hi - 1] == "." or (text[hi - 1] == ":" and text[hi - 2 : hi] != "::")):
        hi -= 1
    part = text[lo:hi]
    if part.count(":") < 2 or len(part) > 45 or sum(map(bool, part.split(":"))) < 3 or not _edge(text, lo, hi):
        return lo, lo, end
    try:
        ipaddress.IPv6Address(part)
    except ValueError:
        return lo, lo, end
    return lo, hi, end


def merge(found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Overlapping findings as one, of the kind of the longest."""
    out: list[tuple[str, int, int]] = []
    best = (0, 0)
    for kind, lo, hi in sorted(found, key=lambda x: (x[1], -x[2], KINDS.index(x[0]))):
        size = (hi - lo, -KINDS.index(kind))
        if out and lo < out[-1][2]:
            out[-1] = (kind if size > best else out[-1][0], out[-1][1], max(hi, out[-1][2]))
            best = max(best, size)
        else:
            out.append((kind, lo, hi))
            best = size
    return out


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end), in order, not overlapping."""
    if not text:
        return []
    if not _anchors:
        _anchors.append(_automaton())
    found: list[tuple[str, int, int]] = []
    read = hexes = values = 0  # to where digits, hexadecimal digits and values of cues have been read
    for end, (anchor, length) in _anchors[0].iter(text):
        lo, hi = end - length + 1, end + 1
        if anchor == "digits":
            if lo >= 2 and text[lo - 1].isupper() and text[lo - 2].isupper() and (to := _iban(text, lo - 2)):
                found.append(("IBAN", lo - 2, to))
            if hi > read:
                start = lo
                while start > read and text[start - 1] in _LEFT:
                    start -= 1
                read = _RUN.match(text, start).end()
                found += _numbers(text, start, read)
        elif anchor == "@":
            if span := _email(text, lo):
                found.append(("EMAIL", *span))
        elif anchor == ":":
            if lo >= hexes:
                a, b, hexes = _address(text, lo)
                if b > a:
                    found.append(("IP", a, b))
        elif anchor == "AKIA":
            if (m := _AKIA.match(text, lo)) and (not lo or not text[lo - 1].isalnum()):
                found.append(("KEY", lo, m.end()))
        elif anchor == "://":
            if m := _URL.match(text, lo):
                start = lo
                while start and text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "+.-"):
                    start -= 1
                found.append(("URL", start, m.end()))
        elif hi >= values:
            if (m := _VALUE.match(text, hi)) and (any(c.isdigit() for c in m[1]) or len(m[1]) >= 16):
                found.append(("SECRET", m.start(1), m.end(1)))
                values = m.end(1)
            if anchor == "password" and (m := _PASSWORD.match(text, hi)):
                value = m[2].rstrip(".!?)]}")
                if len(value) >= 4 and (m[1] == "=" or (len(value) >= 6 and value.lower() not in NO_PASSWORDS)):
                    found.append(("SECRET", m.start(2), m.start(2) + len(value)))
                    values = max(values, m.start(2) + len(value))
    return merge(found)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    parts, at = [], 0
    for kind, lo, hi in spans:
        parts += [text[at:lo], f"[{kind}]"]
        at = hi
    return "".join(parts + [text[at:]])


_FOUND = "struct<redacted:string,kinds:array<string>,starts:array<int>,ends:array<int>>"


def _scan(texts: pa.Array) -> pa.Array:
    new, kinds, starts, ends = [], [], [], []
    for text in (t for at, to in ranges(texts) for t in texts.slice(at, to - at).to_pylist()):
        spans = find(text)
        new.append(redact(text, spans) if spans else None)
        kinds.append([s[0] for s in spans])
        starts.append([s[1] for s in spans])
        ends.append([s[2] for s in spans])
    return pa.StructArray.from_arrays([pa.array(new, pa.string()), pa.array(kinds, pa.list_(pa.string())), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))], ["redacted", "kinds", "starts", "ends"])


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, text, kinds, starts, ends) for each row with findings: the redacted text, and where, in characters
    of the whole original, each finding was."""
    found = bounded(docs).select("doc_id", F.arrow_udf(_scan, _FOUND)("text").alias("found"))
    return found.where("found.redacted is not null").select("doc_id", F.col("found.redacted").alias("text"), "found.kinds", "found.starts", "found.ends")


def redact_documents(docs: DataFrame) -> DataFrame:
    """Every row, with findings replaced in ``text`` and ``n_chars``, if there is such a column, counted again."""
    found = fresh(docs, "found")
    out = bounded(docs).withColumn(found, F.arrow_udf(_scan, _FOUND)("text"))
    hit = F.col(found)["redacted"].isNotNull()
    cols = {"text": F.coalesce(F.col(found)["redacted"], F.col("text"))}
    if "n_chars" in docs.columns:
        cols["n_chars"] = F.when(hit, F.char_length(F.col(found)["redacted"]).cast("long")).otherwise(F.col("n_chars"))
    return out.withColumns(cols).select(*docs.columns)
