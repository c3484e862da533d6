"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, digits, plus signs, URL schemes and cues for
accounts. Each anchor is expanded by a deterministic reader of its kind, which looks only at the characters around
it and decides alone: how far an e-mail address reaches to either side, whether four numbers make an address,
whether a card number passes its check digit. Readers never look behind the end of the last span of their kind,
so spans of a kind are the leftmost ones and do not overlap, and what fails is dropped.

Base kinds: email, ip, card, phone. Added kinds: url (scheme and host), account (a cue followed by 6 to 34
letters and digits of which 6 are digits; with a checksum if it has the form of an IBAN).

Defined results: a null text is empty and has no spans; neither has an empty one. A very long text is scanned whole.
Rows that repeat an id, and rows without one, are scanned each for itself. Where spans of two kinds begin at one
place both are listed, in the order of kinds. An empty table gives an empty result. Columns besides id and text are
ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame

from quire.llm.spans import Span, scan

BASE, ADDED = ("email", "ip", "card", "phone"), ("url", "account")
DIGITS = "0123456789"
# fixed patterns, read from an anchor on
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://")
CUES = ("iban", "account", "acct", "konto", "compte", "cuenta")
HOST = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+(?::[0-9]{1,5})?(?:/[A-Za-z0-9._~%!$&'()*+,;=:@/?#-]*)?")
ACCOUNT = re.compile(r"(?:\x20?(?:number|no\.?|nr\.?|#))?[\x20:=#]{1,3}((?:[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{1,4}){2,8}|[A-Z0-9-]{6,34}))(?![A-Za-z0-9])")


@lru_cache(maxsize=1)
def anchors():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in [("@", "@"), ("+", "+"), *((d, "0") for d in DIGITS), *((s, "s") for s in SCHEMES), *((v, "c") for c in CUES for v in (c, c.capitalize(), c.upper()))]:
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def iban(number: str) -> bool:
    turned = number[4:] + number[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def _email(text: str, at: int, free: int) -> tuple[int, int] | None:
    start = at
    while start > free and text[start - 1] in LOCAL:
        start -= 1
    right = DOMAIN.match(text, at + 1) if start < at else None
    return (start, right.end()) if right else None


def _account(text: str, end: int) -> tuple[int, int] | None:
    m = ACCOUNT.match(text, end)
    if not m:
        return None
    value = m.group(1).replace(" ", "").replace("-", "")
    if not 6 <= len(value) <= 34 or len(_digits(value)) < 6:
        return None
    if re.match("[A-Z]{2}[0-9]{2}", value) and not iban(value):
        return None
    return m.span(1)


def find(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans)."""
    base: list[Span] = []
    added: list[Span] = []
    email_free = ip_free = card_free = phone_free = url_free = account_free = 0
    for last, (kind, size) in anchors().iter(text):
        at = last - size + 1
        if kind == "0":
            if at >= ip_free and (m := IP.match(text, at)):
                ip_free = m.end()
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                    base.append(("ip", *m.span()))
            elif at >= ip_free:  # the rest of this run of digits would fail alike
                ip_free = _run_end(text, at)
            if at >= card_free and (m := CARD.match(text, at)):
                card_free = m.end()
                number = _digits(m.group())
                if 14 <= len(number) <= 19 and luhn(number):
                    base.append(("card", *m.span()))
        elif kind == "@":
            if at >= email_free and (span := _email(text, at, email_free)):
                email_free = span[1]
                base.append(("email", *span))
        elif kind == "+":
            if at >= phone_free and (m := PHONE.match(text, at)):
                phone_free = m.end()
                if 10 <= len(_digits(m.group())) <= 15:
                    base.append(("phone", *m.span()))
        elif kind == "s":
            if at >= url_free and (m := HOST.match(text, last + 1)):
                url_free = m.end()
                added.append(("url", at, url_free))
        elif at >= account_free and (at == 0 or not text[at - 1].isalnum()) and (span := _account(text, last + 1)):
            account_free = span[1]
            added.append(("account", *span))
    return base, added


def _run_end(text: str, at: int) -> int:
    n = len(text)
    while at < n and "0" <= text[at] <= "9":
        at += 1
    return at


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added and n_total (all spans) of every whole text."""
    return scan(docs, find, BASE, ADDED, id_col, text_col)
