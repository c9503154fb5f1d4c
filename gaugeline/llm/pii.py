"""Personal data in texts: anchors found by one automaton, widened and checked by local parsers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Order in which spans are listed.
KINDS = ("email", "ip", "card", "phone", "url", "secret", "ssn", "iban", "account", "address")

# Cues that announce an identifier, and words that end or begin a street's name.
SECRET_CUES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api key", "access_key")
SSN_CUES = ("ssn", "social security")
ACCOUNT_CUES = ("account number", "account no", "acct", "passport", "customer id", "user id", "kontonummer", "cuenta")
STREET_CUES = (" street", " avenue", " road", " boulevard", " lane", "straße", "strasse", " rue ", " calle ")

# Characters of an IBAN by its country.
IBAN_SIZES = {country: size for size, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}

# A match starts a run of digits, as one inside it would also start there; so a long run is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_URL_STOP = re.compile(r"[\s<>\"'/@]")
_URL_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++(?::[0-9]{1,5})?(?:[/?#][^\s<>\"']*)?")
_SECRET = re.compile(r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?([^\s\"',;]{6,}+)")
_SECRET_LEAD = re.compile(r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?")
_KEY_ID = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])")
_SSN = re.compile(r"[^0-9\n]{0,12}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])")
_IBAN = re.compile(r"[^A-Z0-9\n]{0,8}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")
_ACCOUNT = re.compile(r"[^A-Za-z0-9\n]{0,4}([A-Z]{0,3}[0-9][0-9-]{4,18}[0-9])(?![A-Za-z0-9])")
_HOUSE_BEFORE = re.compile(r"(?<![\w.])[0-9]{1,5}[A-Za-z]?(?: [A-ZÀ-Þ][\w'.-]{1,24}){1,4}$")
_HOUSE_AFTER = re.compile(r"(?:[A-ZÀ-Þa-zß-ÿ'.-]{0,24} ){0,4}[0-9]{1,5}[a-z]?(?![\w])")


def _cased(cue: str) -> set[str]:
    return {cue, cue.upper(), cue.title(), cue.capitalize(), cue[:1] + cue[1:].capitalize()}


def build_automaton() -> ahocorasick.Automaton:
    """Anchors of all kinds; the value is ``(kind, length)``."""
    automaton = ahocorasick.Automaton()
    anchors = {"@": "email", "://": "url", "www.": "url", "+": "phone", "AKIA": "key"}
    for kind, cues in (("secret", SECRET_CUES), ("ssn", SSN_CUES), ("iban", ("iban",)), ("account", ACCOUNT_CUES), ("address", STREET_CUES)):
        anchors |= {form: kind for cue in cues for form in _cased(cue)}
    anchors |= {str(d): "digit" for d in range(10)}
    for text, kind in anchors.items():
        automaton.add_word(text, (kind, len(text)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    text = text.replace(" ", "")
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def iban_end(text: str) -> int | None:
    """Where a valid number ends that ``text`` starts with, with what follows it: by its country, else the longest one of whole groups."""
    ends = [i + 1 for i, c in enumerate(text) if c != " "]
    if size := IBAN_SIZES.get(text[:2]):
        ends = ends[size - 1:size]
    else:
        ends = [end for end in reversed(ends) if text[end:end + 1] in ("", " ")]
    return next((end for end in ends if iban_valid(text[:end])), None)


def _emails(text: str, signs: list[int]) -> list[tuple[int, int]]:
    """Each at-sign widened over the local part to its left and the domain to its right."""
    out, free = [], 0
    for at in signs:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            out.append((start, domain.end()))
            free = domain.end()
    return out


def _urls(text: str, anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Each scheme or ``www.`` widened over what follows it: a user up to an at-sign, if there is one, and the host.

    An anchor inside an address that was read ends with it; the end of a user and the host behind it are found once
    for all anchors before them, so the time is linear in the text.
    """
    out, read, stop, behind = [], 0, -1, None
    for start, end in anchors:
        if start < read:
            continue
        scheme = start
        while text[start] == ":" and scheme > 0 and start - scheme < 12 and text[scheme - 1].isascii() and text[scheme - 1].isalpha():
            scheme -= 1
        if text[start] == ":" and scheme == start:
            continue
        if stop < end:
            found = _URL_STOP.search(text, end)
            stop = found.start() if found else len(text)
            behind = _URL_HOST.match(text, stop + 1) if found and text[stop] == "@" else None
        if rest := (behind if end < stop else None) or _URL_HOST.match(text, end):
            read = rest.end()
            out.append((scheme, scheme + len(text[scheme:read].rstrip(".,;:!?)"))))
    return out


def _matched(pattern: re.Pattern, text: str, good) -> list[tuple[int, int]]:
    return [m.span() for m in pattern.finditer(text) if good(m.group())]


def _ip_good(match: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.split("."))


def _card_good(match: str) -> bool:
    digits = match.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def _phone_good(match: str) -> bool:
    return 8 <= sum("0" <= c <= "9" for c in match) <= 15


def find_spans(text: str | None, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by kind in the order of KINDS, then by start."""
    if not text:
        return []
    at: dict[str, list[tuple[int, int]]] = {}
    for last, (kind, size) in automaton.iter(text):
        at.setdefault(kind, []).append((last + 1 - size, last + 1))
    if not at:
        return []
    found: dict[str, list[tuple[int, int]]] = {}
    if "email" in at:
        found["email"] = _emails(text, [start for start, _ in at["email"]])
    if "digit" in at:
        found["ip"] = _matched(_IP, text, _ip_good)
        found["card"] = _matched(_CARD, text, _card_good)
        if "phone" in at:
            found["phone"] = _matched(_PHONE, text, _phone_good)
    if "url" in at:
        found["url"] = _urls(text, at["url"])
    for start, _ in at.get("key", ()):
        if (m := _KEY_ID.match(text, start)) and not (start and text[start - 1].isalnum()):
            found.setdefault("secret", []).append(m.span())
    for kind, pattern, good in (("secret", _SECRET, lambda v: any(c.isdigit() for c in v)), ("ssn", _SSN, lambda v: v[:3] not in ("000", "666")),
                                ("iban", _IBAN, iban_end), ("account", _ACCOUNT, lambda v: True)):
        read = 0
        for start, end in at.get(kind, ()):
            if start and text[start - 1].isalnum():
                continue
            if kind == "secret":  # a value inside one that was read ends with it, so it is not read again
                if not (lead := _SECRET_LEAD.match(text, end)) or lead.end() < read:
                    continue
                if m := pattern.match(text, end):
                    read = m.end()
            if (m := pattern.match(text, end)) and (size := good(m.group(1))):
                found.setdefault(kind, []).append((m.start(1), m.start(1) + size if kind == "iban" else m.end(1)))
    for start, end in at.get("address", ()) if "digit" in at else ():
        before = _HOUSE_BEFORE.search(text, max(0, start - 110), start)
        if before:
            found.setdefault("address", []).append((before.start(), end))
        elif after := _HOUSE_AFTER.match(text, end):
            found.setdefault("address", []).append((start + (text[start] == " "), after.end()))
    out = []
    for kind in KINDS:
        free = 0
        for start, end in sorted(set(found.get(kind, ()))):
            if start >= free:
                out.append((kind, start, end))
            elif end > free:
                out[-1] = (kind, out[-1][1], end)
            free = max(free, end)
    return out


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for each row: ``spans`` is an array of ``kind, start, end`` in code points.

    One automaton finds anchors: at-signs, schemes, plus signs, digits, and cues such as ``password`` or ``IBAN``. From an anchor a
    parser of the kind widens to both sides and checks what it has: domains, parts of addresses,
    check digits, lengths. Spans of one kind that overlap are one, their union; spans of two kinds may overlap.

    Null and empty texts have no spans; rows are judged one by one, whatever their id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t, automaton)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["id", "spans"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {dict(plain.dtypes)['id']}, spans array<struct<kind: string, start: int, end: int>>"
    return plain.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each span in the text replaced by ``[KIND]``; overlapping spans, as one, by the earliest one's kind.

    All rows and columns stay; null and empty texts stay as they are.
    """
    position, columns = docs.columns.index(text_col), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton()
        for batch in batches:
            texts = batch.column(position).to_pylist()
            for i, text in enumerate(texts):
                out, free = [], 0
                for kind, start, end in sorted(find_spans(text, automaton), key=lambda s: (s[1], -s[2])):
                    if start >= free:
                        out += [text[free:start], f"[{kind.upper()}]"]
                    free = max(free, end)
                if out:
                    texts[i] = "".join(out) + text[free:]
            yield batch.set_column(position, columns[position], pa.array(texts, batch.schema.field(position).type))

    return docs.mapInArrow(run, docs.schema)
