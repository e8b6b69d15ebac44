"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, URL schemes, plus signs, digits
and identifier cues. At each anchor a deterministic local parser expands to the left and right, fixes the
boundaries and validates (part ranges, Luhn, digit counts, IBAN check digits). Kinds email, ip, card and phone
are the base; login (user part of a URL), iban, ssn and account (digits after a cue) are added by the cues.

Defined cases: null text is empty (no spans); spans are code points, end exclusive, in each kind leftmost and
non-overlapping, and a span that fails its check uses up its characters (an iban none); an iban ends after its country's
length, for other countries at the last group border of 15 to 34 characters that passes the check; repeated rows are reported each; an
empty table gives no rows; a text of any length is scanned whole.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkwright.llm.textutil import texts_of

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("login", "iban", "ssn", "account")
# Boundary patterns of the local parsers, matched at the anchor only.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
DIGITS = re.compile(r"[0-9]+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
USERINFO = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=-]+:[^\s/@]+@")
IBAN = re.compile(r"[\x20:#.=]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
IBAN_LENGTHS = {c: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in countries.split()}
SSN = re.compile(r"[\x20:#.=]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
ACCOUNT = re.compile(r"(?:\x20(?:no|nr|number))?[\x20:#.=]{1,4}([0-9]{6,17})(?![0-9])")
CUES = {"iban": "iban", "ssn": "ssn", "account": "account", "acct": "account", "konto": "account", "compte": "account", "cuenta": "account"}


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word("@", ("at", 1))
    a.add_word("://", ("scheme", 3))
    a.add_word("+", ("plus", 1))
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
    for cue, kind in CUES.items():
        for form in (cue, cue.upper(), cue.capitalize()):
            a.add_word(form, (kind, len(form)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def iban_end(text: str, start: int, end: int) -> int | None:
    """Where the IBAN that begins the run start..end of groups ends; None if no length passes the check."""
    ends = [i + 1 for i in range(start, end) if text[i] != " "]
    size = IBAN_LENGTHS.get(text[start:start + 2])
    if size:
        tried = ends[size - 1:size]
    else:
        tried = [e for e in reversed(ends[14:]) if not (text[e:e + 1].isascii() and text[e:e + 1].isalnum())]
    return next((e for e in tried if _iban_ok(text[start:e])), None)


def spans_of(text: str, anchors) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of all personal data in text, sorted."""
    out = []
    done = dict.fromkeys(KINDS, 0)      # in each kind, characters before this are used up
    run_end = 0                         # end of the digit run last seen

    def take(kind, start, end, ok):
        done[kind] = end
        if ok:
            out.append((KINDS.index(kind), start, end))

    def cued(kind, pattern, after):
        m = pattern.match(text, after)
        if m and m.start(1) >= done[kind]:
            end = iban_end(text, *m.span(1)) if kind == "iban" else m.end(1)
            if end:
                take(kind, m.start(1), end, True)

    for last, (anchor, width) in anchors.iter(text):
        i = last - width + 1
        if anchor == "digit":
            if i < run_end:
                continue
            run_end = DIGITS.match(text, i).end()
            if i >= done["ip"] and (m := IP.match(text, i)):
                take("ip", i, m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")))
            if i >= done["card"] and (m := CARD.match(text, i)):
                digits = m.group().replace(" ", "").replace("-", "")
                take("card", i, m.end(), 13 <= len(digits) <= 19 and luhn(digits))
        elif anchor == "at":
            start = i
            while start > done["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < i and (m := DOMAIN.match(text, i + 1)):
                take("email", start, m.end(), True)
        elif anchor == "plus":
            if i >= done["phone"] and (m := PHONE.match(text, i)):
                take("phone", i, m.end(), 9 <= sum(c.isdigit() for c in m.group()) <= 15)
        elif anchor == "scheme":
            start = i
            while start > done["login"] and text[start - 1] in SCHEME:
                start -= 1
            if start < i and (m := USERINFO.match(text, last + 1)):
                take("login", start, m.end() - 1, True)
        elif anchor == "iban":
            cued("iban", IBAN, last + 1)
        elif anchor == "ssn":
            cued("ssn", SSN, last + 1)
        else:
            cued("account", ACCOUNT, last + 1)
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id_col, n_<base kind>, base_sha256, spans for every row of docs; no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        anchors = automaton()
        for batch in batches:
            found = [spans_of(t.decode("utf-8", "replace"), anchors) for t in texts_of(batch)]
            base = [[s for s in spans if s[0] < len(BASE)] for spans in found]
            counts = [pa.array([sum(s[0] == k for s in spans) for spans in base], pa.int64()) for k in range(len(BASE))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()),
                 pa.array([joined(s) for s in found], pa.string())],
                names=[id_col, *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    return docs.select(id_col, "text").mapInArrow(
        run, f"`{id_col}` {id_type}, {', '.join(f'n_{k} long' for k in BASE)}, base_sha256 string, spans string")
