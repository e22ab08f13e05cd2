"""Personal data by anchor expansion: an Aho-Corasick automaton finds at-signs, plus signs, digits, schemes and identifier cues
in one pass over a text; a parser of each anchor's kind grows it to its boundaries and checks what it found."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import appended_text, mapper

#: Kinds in the order in which spans of one start go; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "address", "account")
BASE = KINDS[:4]
#: Words that announce an identifier, found in lower case, in capitals and with a capital letter, but not inside a word.
CUES = ("account", "acct", "iban", "bic", "ssn", "passport", "licence", "license no", "customer id", "user id", "patient id", "tax id", "token", "secret", "password", "api key", "api_key")

_DIGITS = frozenset("0123456789")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_FOUR = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_CALL = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_REST = re.compile(r"[^\s\"'<>`{}|\\^]++")
_HOST = re.compile(r"(?:[^\s/?#@\"'<>]*+@)?(?:[\w-]++(?:\.[\w-]++)*+|\[[0-9A-Fa-f:.]++\])(?::[0-9]{1,5}+)?+")
_LINK = re.compile(r"[ \t]*+(?:(?:no|nr|number|id)\b\.?)?+[ \t]*+[:=#]?+[ \t]*+[\"']?+", re.I)
_VALUE = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9_-]|[ ](?=[A-Z0-9]{1,4}+(?![A-Za-z0-9]))){0,255}+")
Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    """Whether the check digit of a number fits."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _iban(value: str) -> bool:
    v = value.replace(" ", "").upper()
    return 15 <= len(v) <= 34 and v[:2].isalpha() and v[2:4].isdigit() and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


@lru_cache(maxsize=1)
def _anchors():
    import ahocorasick

    found = ahocorasick.Automaton()
    for sign in ("@", "://", "+"):
        found.add_word(sign, (sign, len(sign)))
    for d in "0123456789":
        found.add_word(d, ("0", 1))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
            found.add_word(form, ("cue", len(form)))
    for scheme in ("mailto:", "tel:", "MAILTO:", "TEL:", "Mailto:", "Tel:"):
        found.add_word(scheme, ("scheme", len(scheme)))
    found.make_automaton()
    return found


def _left(text: str, end: int, allowed: frozenset, least: int) -> int:
    """Where the run of allowed characters before end begins, not before least."""
    while end > least and text[end - 1] in allowed:
        end -= 1
    return end


def _address(text: str, sign: int, least: int) -> tuple[int, int] | None:
    """An address with a scheme around its `://`: the scheme before, a host and what follows behind, without closing punctuation."""
    start = _left(text, sign, _SCHEME, max(least, sign - 32))
    while start < sign and not (text[start].isascii() and text[start].isalpha()):
        start += 1
    host = _HOST.match(text, sign + 3) if start < sign else None
    if not host:
        return None
    rest = _REST.match(text, host.end())
    return start, max(host.end(), host.end() + len(rest.group().rstrip(".,;:!?*)]")) if rest else 0)


def _account(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The identifier that a cue announces: 6 to 256 characters with four digits or more; behind the cue of an IBAN a sound one."""
    if (start and (text[start - 1].isalnum() or text[start - 1] == "_")) or (end < len(text) and text[end].isalnum()):
        return None
    value = _VALUE.match(text, _LINK.match(text, end).end())
    if not value:
        return None
    found = value.group().rstrip("-_")
    whole = "iban" not in text[start:end].lower() or _iban(found)
    if not whole or len(found) < 6 or sum(c in _DIGITS for c in found) < 4:
        return None
    return value.start(), value.start() + len(found)


def find(text: str) -> list[Span]:
    """(start, kind, end) of the spans of a text, code points, in order of start and kind.

    Base kinds are what their patterns match from left to right without overlaps: an e-mail address grows from its at-sign to
    the left, no further than the one before, and to the right; a number grows to the right from its first digit. What fails
    its check is dropped, and the search goes on behind it."""
    out: list[Span] = []
    mail = four = chain = line = place = 0  # ends of the last match of each kind
    for last, (kind, size) in _anchors().iter(text):
        at = last + 1 - size
        if kind == "0":
            if at >= chain and (m := _CHAIN.match(text, at)):
                chain = m.end()
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((at, 2, chain))
            if at >= four and (not at or text[at - 1] not in _DIGITS) and (m := _FOUR.match(text, at)):
                four = m.end()
                parts = [p.lstrip("0") for p in m.groups()]
                if all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts):
                    out.append((at, 1, four))
        elif kind == "@":
            start, domain = _left(text, at, _LOCAL, mail), _DOMAIN.match(text, last + 1)
            if start < at and domain:
                mail = domain.end()
                out.append((start, 0, mail))
        elif kind == "+":
            if m := _CALL.match(text, at):
                if 10 <= sum(c in _DIGITS for c in m.group()) <= 15:
                    out.append((at, 3, m.end()))
        elif kind == "://":
            if at >= place and (got := _address(text, at, place)):
                place = got[1]
                out.append((got[0], 4, got[1]))
        elif kind == "scheme":
            rest = _REST.match(text, last + 1)
            body = rest.group().rstrip(".,;:!?*)]") if rest else ""
            if at >= place and len(body) > 3 and ("@" in body or any(c in _DIGITS for c in body)):
                place = last + 1 + len(body)
                out.append((at, 4, place))
        elif at >= line and (got := _account(text, at, last + 1)):
            line = got[1]
            out.append((got[0], 5, got[1]))
    return sorted(set(out))


def redact(text: str, spans: Iterable[Span] | None = None) -> str:
    """A text with each span, or group of spans that overlap, as the kind of its first: <email>."""
    out, done, end = [], 0, -1
    for start, kind, stop in find(text) if spans is None else spans:
        if start >= end:
            out += [text[done:start], f"<{KINDS[kind]}>"]
        end = max(end, stop)
        done = end
    return "".join([*out, text[done:]])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end, base>>) of every row: code points, end exclusive, by start, then kind as in KINDS.

    Odd rows: a null text is an empty one and has no spans; null ids and repeated rows are treated like any other; an empty
    table gives no rows; other columns aren't read, whatever their names. A text is searched whole, in time in proportion to
    its length, and batches are cut by bytes, so a text of many megabytes is alone in its batch."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = pa.schema([("id", pa.int64()), ("spans", _SPANS)])

    def found(batch: pa.RecordBatch) -> dict:
        every = [[{"kind": KINDS[k], "start": s, "end": e, "base": k < len(BASE)} for s, k, e in find(t)] for t in batch.column("text").to_pylist()]
        return {"id": batch.column("id"), "spans": every}

    return rows.mapInArrow(mapper(schema, "text", found), "id long, spans array<struct<kind string, start bigint, end bigint, base boolean>>")


def redacted(docs: DataFrame, text_col: str = "text", name: str = "redacted", finder: Callable[[str], Iterator[Span]] = find) -> DataFrame:
    """docs with the redacted text (null where the text is) as a column `name`; other columns pass through. Odd rows as in `spans`."""
    return appended_text(docs, text_col, name, lambda t: None if t is None else redact(t, finder(t)))
