"""Personal data by anchor expansion.

An Aho-Corasick automaton passes over a text once and stops at anchors only: at-signs,
plus signs, digits, schemes (`://`, `tel:`) and identifier cues (`account`, `password`…).
At each anchor a local parser widens the place to the boundaries of an email, an address
or an account and validates it. A parser starts where the last span of its kind ended at
the earliest, so what it finds is what a leftmost scan of the whole text would find.

Base kinds, always reported:
    email  local part and a domain of two labels at least, around `@`
    ip     four numbers joined by dots, each at most 255
    card   13 to 19 digits, single spaces or hyphens between them, passing Luhn
    phone  `+`, then 9 to 15 digits with spaces, brackets, dots and hyphens among them
Further kinds that anchors lead to:
    account  what a cue names: an IBAN passing its check digits, or an identifier with a
             digit after `:`, `=`, `#`, `no` or a space, 6 characters at least
    tel      7 to 15 digits after `tel:` (without the `+` that makes them a phone)
    url      an address whose scheme is followed by `user:password@`

A task scans the documents it reads, so there is no shuffle, and holds one slice of them.

Defined cases: a null or empty text has no spans; rows with equal or null ids are scanned
each for itself; very long texts are scanned whole, in time that grows with their length;
other columns are not read; an empty table gives no rows. Positions are code points.
"""

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import one_array, text_slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "tel", "url")

# Words that announce an identifier.
CUES = (
    "account", "acct", "iban", "ssn", "passport", "customer id", "user id", "username",
    "login", "password", "passwd", "token", "api key", "api_key", "secret",
)

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*").match
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*").match
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").match
_TEL = re.compile(r"[0-9][ ().0-9-]*[0-9]").match
_USERINFO = re.compile(r"[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[^\s\"'<>]*)?").match
_GAP = re.compile(r"(?:[ _-]?(?:no|number|id|nr)\b\.?)?[ \t]*[:=#]?[ \t]*[\"']?", re.IGNORECASE).match
_IDENTIFIER = re.compile(r"[A-Za-z0-9][A-Za-z0-9_./+-]*[A-Za-z0-9]").match
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])").match
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
_DOUBLED = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]

_AT, _PLUS, _NUMBER, _ADDRESS, _CALL, _CUE = range(6)


@lru_cache(maxsize=1)
def _anchors():
    import ahocorasick

    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, (_NUMBER, 1))
    found.add_word("@", (_AT, 1))
    found.add_word("+", (_PLUS, 1))
    found.add_word("://", (_ADDRESS, 3))
    for word in ("tel:", "Tel:", "TEL:"):
        found.add_word(word, (_CALL, 4))
    for cue in CUES:
        for word in {cue, cue.capitalize(), cue.upper()}:
            found.add_word(word, (_CUE, len(word)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(_DOUBLED[int(d)] for d in digits[-2::-2])) % 10 == 0


def _is_iban(text: str) -> bool:
    turned = text[4:] + text[:4]
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _ips(text: str, begin: int, end: int):
    """Groups of four numbers of one chain of numbers and dots, from its left."""
    at = begin
    parts = text[begin:end].split(".")
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        size = sum(map(len, four)) + 3
        if all(map(_small, four)):
            yield at, at + size
        at += size + 1


def _account(text: str, end: int) -> tuple[int, int] | None:
    """The identifier that a cue ending at `end` announces."""
    if text[end : end + 1].isalpha():
        return None
    gap = _GAP(text, end).end()
    if gap == end:
        return None
    iban = _IBAN(text, gap)
    if iban and _is_iban(iban[0].replace(" ", "")):
        return iban.span()
    named = _IDENTIFIER(text, gap)
    if named and len(named[0]) >= 6 and any("0" <= c <= "9" for c in named[0]):
        return named.span()
    return None


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of a text, by kind in the order of KINDS, then by start."""
    found = {kind: [] for kind in KINDS}
    done = dict.fromkeys(KINDS, 0)

    def keep(kind, begin, end):
        found[kind].append((kind, begin, end))
        done[kind] = end

    for last, (anchor, size) in _anchors().iter(text):
        begin = last + 1 - size
        if anchor == _NUMBER:
            if begin >= done["card"]:
                end = done["card"] = _DIGITS(text, begin).end()
                if end - begin > 12:
                    digits = text[begin:end].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and _luhn(digits):
                        keep("card", begin, end)
            if begin >= done["ip"]:
                end = _CHAIN(text, begin).end()
                for span in _ips(text, begin, end):
                    keep("ip", *span)
                done["ip"] = end
        elif anchor == _AT:
            domain = _DOMAIN(text, last + 1)
            if domain:
                start = begin
                while start > done["email"] and text[start - 1] in _LOCAL:
                    start -= 1
                if start < begin:
                    keep("email", start, domain.end())
        elif anchor == _PLUS:
            number = _PHONE(text, begin)
            if number and 9 <= sum(map(str.isdigit, number[0])) <= 15:
                keep("phone", *number.span())
        elif anchor == _CALL:
            number = _TEL(text, last + 1)
            if number and 7 <= sum(map(str.isdigit, number[0])) <= 15:
                keep("tel", *number.span())
        elif anchor == _ADDRESS:
            who = _USERINFO(text, last + 1)
            start = begin
            while start > done["url"] and text[start - 1] in _SCHEME:
                start -= 1
            if who and start < begin:
                keep("url", start, who.end())
        elif begin >= done["account"] and not text[begin - 1 : begin].isalnum():
            account = _account(text, last + 1)
            if account:
                keep("account", *account)
    return [span for kind in KINDS for span in found[kind]]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end) of every row of `docs` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        for batch in batches:
            for row, texts in text_slices(batch["text"]):
                ids = one_array(batch["doc_id"]).slice(row, len(texts))
                rows = [
                    [{"kind": k, "start": a, "end": b} for k, a, b in spans(text)]
                    for text in texts.to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([ids, pa.array(rows, _SPANS)], ["doc_id", "spans"])

    schema = f"doc_id {kind}, spans array<struct<kind: string, start: long, end: long>>"
    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s.kind.isin(*kinds))
