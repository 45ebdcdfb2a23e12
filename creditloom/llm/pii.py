"""Personal data by anchor expansion.

One Aho-Corasick pass finds the anchors: at-signs, plus signs, digits, schemes and identifier cues. At each anchor a small
deterministic parser expands to both sides, finds the span's bounds and validates it (parts of an address, check digit of a
card, digits of a phone number). Spans of one kind never overlap; a span that fails its check is dropped and not retried.

Beside the base kinds (email, ip, card, phone) there are ``login`` (user and password in a url) and ``secret`` (a value that
follows an identifier cue). Each sort of cue has its own parser: a password is any run of signs, a key is long or mixed, an
account and a social security number have so many digits with or without separators, and an IBAN may be printed in groups,
has its country's length and passes the mod-97 check. A null or empty text has no spans. Rows are judged one by one; other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
from pyspark.sql import DataFrame

from creditloom.llm.tasks import map_rows
from creditloom.llm.texts import LOWER, UPPER

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "secret")
#: Identifier cues and the parser of what follows.
CUES = {
    "password": "password", "passwd": "password", "pwd": "password", "secret": "password", "token": "key", "api_key": "key", "api-key": "key", "apikey": "key",
    "access_key": "key", "account": "account", "iban": "iban", "ssn": "ssn",
}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
LOGIN = re.compile(r"[^\s/?#@:\"'<>]+:[^\s/?#@\"'<>]+(?=@[A-Za-z0-9])")
#: From a cue to its value; the group is there if a sign or a verb says that a value follows.
LINK = re.compile(r"""s?(?:[ _-]?(?:number|num|no|nr|id|key|code)\b\.?)?["']?(?:[ \t]*([:=#]{1,2}>?|->)|[ ]((?:is|was)\b:?))?[ \t]*""", re.IGNORECASE)
QUOTED = re.compile(r""""([^"\n]+)"|'([^'\n]+)'""")
PASSWORD = re.compile(r"""[^\s"'<>,;]{4,}""")
KEY = re.compile(r"[A-Za-z0-9][A-Za-z0-9_+/.=-]*[A-Za-z0-9_+/=-]")
LONG_KEY, MIXED_KEY = 16, 9
#: An unbroken number, or groups; letters may stand before it.
ACCOUNT = re.compile(r"(?:[A-Za-z]{1,4}[ -]?)?(?:[0-9]{6,}(?:-[0-9]+)*|[0-9]{1,5}(?:[ -][0-9]{2,})+)(?![A-Za-z0-9])")
ACCOUNT_CODE = re.compile(r"[A-Za-z0-9][A-Za-z0-9_+/.=-]{4,}[A-Za-z0-9]")
SSN = re.compile(r"[0-9]{3}([ -]?)[0-9]{2}\1[0-9]{4}(?![A-Za-z0-9])")
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[ \xA0-]?[A-Za-z0-9]){11,30}")
#: Characters of an IBAN by country; others have 15 to 34. Fixed values.
IBAN_CHARS = {
    name: size
    for size, names in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for name in names.split()
}
_LOWER = str.maketrans(UPPER, LOWER)

Span = tuple[int, int, str]


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for sign in "@+0123456789":
        found.add_word(sign, (sign if sign in "@+" else "digit", 1))
    found.add_word("://", ("scheme", 3))
    for cue in CUES:
        found.add_word(cue, (cue, len(cue)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _signs(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def mod_97(iban: str) -> bool:
    """The check digits of an IBAN without separators."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _iban(text: str, at: int) -> tuple[int, int] | None:
    """An IBAN that starts here. Of a country unknown, the longest that passes the check."""
    if not (match := IBAN.match(text, at)):
        return None
    ends = [i + 1 for i in range(at, match.end()) if text[i].isalnum()]  # by number of characters
    signs = "".join(c for c in match[0] if c.isalnum())
    size = IBAN_CHARS.get(signs[:2].upper())
    for n in [size] if size else range(len(signs), 14, -1):
        if n <= len(signs) and not text[ends[n - 1] : ends[n - 1] + 1].isalnum() and mod_97(signs[:n]):
            return at, ends[n - 1]
    return None


def _password(text: str, at: int) -> tuple[int, int] | None:
    """Anything quoted; else a run of signs that is not just a word."""
    if match := QUOTED.match(text, at):
        return at + 1, match.end() - 1
    if match := PASSWORD.match(text, at + (text[at : at + 1] in ("'", '"'))):
        value = match[0].rstrip(".:)]}")
        if len(value) >= 4 and not value.isalpha():
            return match.start(), match.start() + len(value)
    return None


def _key(text: str, at: int) -> tuple[int, int] | None:
    """A digit, and either many signs or letters of both cases."""
    if match := KEY.match(text, at):
        value = match[0]
        mixed = len(value) >= MIXED_KEY and any("a" <= c <= "z" for c in value) and any("A" <= c <= "Z" for c in value)
        if (mixed or len(value) >= LONG_KEY) and _signs(value):
            return match.span()
    return None


def _account(text: str, at: int, told: bool) -> tuple[int, int] | None:
    """An IBAN, 6 to 24 digits with or without separators, or a code with as many; untold, 7 digits or more without blanks."""
    if span := _iban(text, at):
        return span
    if match := ACCOUNT.match(text, at):
        if 6 <= len(_signs(match[0])) <= 24 and (told or (len(_signs(match[0])) >= 7 and " " not in match[0])):
            return match.span()
    if told and (match := ACCOUNT_CODE.match(text, at)) and 6 <= len(_signs(match[0])) <= 24:
        return match.span()
    return None


def secret(text: str, cue: str, at: int) -> tuple[int, int] | None:
    """Bounds of the value of a cue that ends at ``at``."""
    link = LINK.match(text, at)
    told, kind, at = bool(link[1] or link[2]), CUES[cue], link.end()
    if kind == "password":
        return _password(text, at) if told else None
    at += text[at : at + 1] in ("'", '"')
    if kind == "key":
        return _key(text, at) if told else None
    if kind == "account":
        return _account(text, at, told)
    if kind == "iban":
        return _iban(text, at)
    match = SSN.match(text, at)
    return match.span() if match else None


class Finder:
    def __init__(self) -> None:
        self.anchors = _automaton()

    def spans(self, text: str | None) -> list[Span]:
        """All spans as (start, end, kind), by start, then by kind as listed. Anchors come in text order, so each kind only looks ahead."""
        text = text or ""
        out: list[Span] = []
        ends = dict.fromkeys(KINDS, 0)
        run_end = 0  # end of the digit run whose first digit has been tried as an address
        for last, (kind, size) in self.anchors.iter(text.translate(_LOWER)):
            at = last - size + 1
            if kind == "digit":
                if at >= ends["ip"] and at >= run_end:
                    if match := IP.match(text, at):
                        ends["ip"] = match.end()
                        if all(len(p.lstrip("0")) <= 3 and int(p[-4:] if p.lstrip("0") else "0") <= 255 for p in match[0].split(".")):
                            out.append((at, match.end(), "ip"))
                    else:
                        run_end = DIGITS.match(text, at).end()
                if at >= ends["card"] and (match := CARD.match(text, at)):
                    ends["card"] = match.end()
                    digits = _signs(match[0])
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        out.append((at, match.end(), "card"))
            elif kind == "@":
                start = at
                while start > ends["email"] and text[start - 1] in LOCAL:
                    start -= 1
                if start < at and (match := DOMAIN.match(text, at + 1)):
                    ends["email"] = match.end()
                    out.append((start, match.end(), "email"))
            elif kind == "+":
                if at >= ends["phone"] and (match := PHONE.match(text, at)):
                    ends["phone"] = match.end()
                    if 9 <= len(_signs(match[0])) <= 15:
                        out.append((at, match.end(), "phone"))
            elif kind == "scheme":
                if at >= ends["login"] and (match := LOGIN.match(text, at + 3)):
                    ends["login"] = match.end()
                    out.append((at + 3, match.end(), "login"))
            elif at >= ends["secret"] and not (at and text[at - 1].isalnum()) and (found := secret(text, kind, last + 1)):
                ends["secret"] = found[1]
                out.append((*found, "secret"))
        return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with a ``<KIND>`` for each span; overlapping spans share the mark of the first."""
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def find(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns with the count of each base kind, the digest of the base spans, and all spans."""
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        finder = Finder()
        for *kept, body in rows:
            spans = finder.spans(body)
            base = [s for s in spans if s[2] in BASE]
            yield (*kept, *(sum(s[2] == k for s in base) for k in BASE), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans))

    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"n_{k} bigint" for k in BASE), "base_sha256 string, spans string"])
    return map_rows(df.select(*(f"`{c}`" for c in keep), f"`{text}`"), schema, work)


def mask(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the spans of its text masked; a null text stays null."""
    at = df.columns.index(text)

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        finder = Finder()
        for row in rows:
            body = row[at]
            yield (*row[:at], body and masked(body, finder.spans(body)), *row[at + 1 :])

    return map_rows(df, ", ".join(f"`{c}` {t}" for c, t in df.dtypes), work)
