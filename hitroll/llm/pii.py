r"""Personal data in plain and in disguised form, with places in the source text.

Base spans (email addresses, IP numbers, payment cards, phone numbers) come from the text as it
is. Then three transducers rewrite the text, one after the other:

1. characters: digits and letters of other scripts that look like ASCII ones, full-width and
   styled forms, dashes and spaces of all kinds; invisible characters go; character references;
2. spelled digits in four languages (``four one double five``) become digits;
3. disguised ``@`` and ``.`` (``[at]``, ``(dot)``, ``name at host dot org``, ``192 dot 168 ...``,
   blanks round the signs) become the signs; a spelled ``plus`` before a number becomes ``+``.

Each returns its edits, (start, end, replacement) in the text that it read. Detection then runs on
the rewritten text, and what it finds there is mapped back through the edits of all three: a place
inside a replacement stands for the whole of what it replaced. Only spans that an edit touches are
added, and not inside a base span of their kind. Everything is linear in the text; texts without
any edit are scanned once.

Plain words are left alone: a bare ``at`` counts only before a host whose labels are joined by
disguised dots, a bare ``dot`` only in such a host, in the name before it, or between four numbers;
one spelled digit alone only next to a digit or a word for a dot.

Defined results: null or empty text has no spans; repeated rows are scanned alike; spans come by
kind, then start; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitroll.llm.common import table

KINDS = ("email", "ip", "card", "phone")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ODD_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``local@host``. A match starts where the run of local characters before
    an ``@`` does, or where the last match ended; each run is read once."""
    end, at = 0, text.find("@")
    while at >= 0:
        run = _LOCAL.match(text[end:at][::-1])
        host = run and _HOST.match(text, at + 1)
        if host:
            yield at - run.end(), host.end()
            end = host.end()
        else:
            end = at + 1
        at = text.find("@", end)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p := g.lstrip("0")) < 4 and int(p or 0) <= 255 for g in m.groups()):
            yield m.span()


def luhn(digits: str) -> bool:
    return sum(_ODD_DOUBLED[int(d)] if k % 2 else int(d) for k, d in enumerate(digits[::-1])) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
                yield m.span()


DETECTORS = (emails, ips, cards, phones)


# --- Transducers. What stands for what. ---

#: Letters of other scripts that look like ASCII ones.
LOOKALIKES = {
    "a": "аɑα", "b": "Ьƅ", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іıɩι", "j": "ј",
    "k": "κк", "l": "ӏǀ", "m": "м", "n": "ոп", "o": "оοօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ",
    "t": "т", "u": "υս", "v": "ѵν", "w": "ԝѡ", "x": "хχ", "y": "уγ", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙӀ", "J": "Ј", "K": "КΚ", "M": "МΜ",
    "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ",
    ".": "․。", "@": "＠﹫", "+": "＋﹢",
}
#: Digits in English, German, French and Spanish.
SPELLED = {
    "zero": "0", "oh": "0", "null": "0", "zéro": "0", "cero": "0",
    "one": "1", "eins": "1", "un": "1", "uno": "1",
    "two": "2", "zwei": "2", "zwo": "2", "deux": "2", "dos": "2",
    "three": "3", "drei": "3", "trois": "3", "tres": "3",
    "four": "4", "vier": "4", "quatre": "4", "cuatro": "4",
    "five": "5", "fünf": "5", "fuenf": "5", "cinq": "5", "cinco": "5",
    "six": "6", "sechs": "6", "seis": "6",
    "seven": "7", "sieben": "7", "sept": "7", "siete": "7",
    "eight": "8", "acht": "8", "huit": "8", "ocho": "8",
    "nine": "9", "neun": "9", "neuf": "9", "nueve": "9",
}
TIMES = {"double": 2, "triple": 3}
AT_WORDS = ("at", "arroba", "arobase", "ät", "klammeraffe")
DOT_WORDS = ("dot", "punkt", "point", "punto")
PLUS_WORDS = ("plus", "más", "mas")
REFERENCES = {"&commat;": "@", "&period;": ".", "&plus;": "+", "&hyphen;": "-", "&nbsp;": " "}

_LOOKS = {c: a for a, cs in LOOKALIKES.items() for c in cs}
_PLAIN: dict[str, str | None] = {}      # of characters met so far


def plain(c: str) -> str | None:
    """What a character beyond ASCII stands for; None if it stands for itself."""
    if c not in _PLAIN:
        kind, form = unicodedata.category(c), unicodedata.normalize("NFKC", c)
        digit = unicodedata.decimal(c, None)
        _PLAIN[c] = (_LOOKS[c] if c in _LOOKS else str(digit) if digit is not None
                     else "" if kind == "Cf" or "︀" <= c <= "️" else "-" if kind == "Pd" or c == "−"
                     else " " if kind == "Zs" else form if len(form) == 1 and form.isascii() else None)
    return _PLAIN[c]


_REFERENCE = re.compile(r"&(?:#0{0,5}([0-9]{1,7})|#[xX]0{0,5}([0-9a-fA-F]{1,6}));|"
                        + "|".join(REFERENCES))


def character_edits(text: str) -> list:
    out = []
    if not text.isascii():
        odd = {c: p for c in set(text) if c > "\x7f" and (p := plain(c)) is not None}
        if odd:
            some = re.compile("[" + re.escape("".join(sorted(odd))) + "]")
            out = [(m.start(), m.end(), odd[m[0]]) for m in some.finditer(text)]
    if "&" in text:
        for m in _REFERENCE.finditer(text):
            code = int(m[1]) if m[1] else int(m[2], 16) if m[2] else None
            c = REFERENCES.get(m[0]) if code is None else chr(code) if 32 <= code < 127 else None
            if c:
                out.append((m.start(), m.end(), c))
        out.sort()
    return out


_NUMBER_WORD = re.compile(r"\b(?:" + "|".join(sorted([*SPELLED, *TIMES], key=len, reverse=True))
                          + r")\b", re.I)
_BETWEEN = {" ", "-", ", ", "  "}
#: What stands next to a spelled digit that counts alone: a digit, or the word for a dot.
_BEHIND = re.compile(rf"(?i)(?:[0-9][ -]?|\b(?:{'|'.join(DOT_WORDS)})[\])}}]?[ ]{{0,3}})$")
_AHEAD = re.compile(rf"(?i)[ -]?[0-9]|[ ]{{0,3}}[\[({{]?(?:{'|'.join(DOT_WORDS)})\b")


def digit_edits(text: str) -> list:
    """Runs of spelled digits, each as one edit; one alone counts only next to a digit."""
    out, run = [], []

    def close():
        digits, times = "", 1
        for a, b in run:
            w = text[a:b].lower()
            if w in TIMES:
                times = TIMES[w]
            else:
                digits, times = digits + SPELLED[w] * times, 1
        if times > 1:                           # "double" of nothing
            run.pop()
        if not run or not digits:
            return
        a, b = run[0][0], run[-1][1]
        if len(digits) > 1 or _BEHIND.search(text[max(0, a - 16):a]) or _AHEAD.match(text[b:b + 16]):
            out.append((a, b, digits))

    for m in _NUMBER_WORD.finditer(text):
        if run and text[run[-1][1]:m.start()] not in _BETWEEN:
            close()
            run.clear()
        run.append(m.span())
    if run:
        close()
    return out


_BLANK = r"[ \t]"
_OPEN, _SHUT = r"[\[({<]", r"[\])}>]"
_SOFT_AT = re.compile(
    rf"{_BLANK}{{0,3}}{_OPEN}{_BLANK}?(?:{'|'.join(AT_WORDS)}|@){_BLANK}?{_SHUT}{_BLANK}{{0,3}}"
    rf"|{_BLANK}{{1,3}}@{_BLANK}{{0,3}}|@{_BLANK}{{1,3}}"
    rf"|{_BLANK}{{1,3}}(?:{'|'.join(AT_WORDS)}){_BLANK}{{1,3}}|(?<=\w)_at_(?=\w)|-at-|%40", re.I)
_SOFT_DOT = re.compile(
    rf"{_BLANK}{{0,3}}{_OPEN}{_BLANK}?(?:{'|'.join(DOT_WORDS)}|\.){_BLANK}?{_SHUT}{_BLANK}{{0,3}}"
    rf"|{_BLANK}{{1,3}}(?:{'|'.join(DOT_WORDS)}){_BLANK}{{1,3}}"
    rf"|{_BLANK}{{1,3}}\.{_BLANK}{{0,3}}|_dot_|-dot-|%2e", re.I)
_LABEL = re.compile(r"[A-Za-z0-9-]+?(?=[-_]dot[-_])|[A-Za-z0-9-]+", re.I)
_SURE_AT = re.compile(rf"{_OPEN}|%40|@")
_DIGITS = re.compile(r"[0-9]+")
_PLUS = re.compile(rf"\b(?:{'|'.join(PLUS_WORDS)}){_BLANK}{{0,2}}(?=[0-9(])", re.I)
_DOT_HINTS = (*DOT_WORDS, "[.", "(.", "{.", "<.", "[ .", "( .", " .", "%2e")


def sign_edits(text: str) -> list:
    """Disguised ``@`` and ``.`` of addresses, ``.`` of IP numbers, and spelled ``+``."""
    low = text.lower()
    out = []
    if any(w in low for w in PLUS_WORDS):
        out += [(m.start(), m.end(), "+") for m in _PLUS.finditer(text)]
    dots = ([m.span() for m in _SOFT_DOT.finditer(text)]
            if any(h in low for h in _DOT_HINTS) else [])
    starts, ends = {a: b for a, b in dots}, {b: a for a, b in dots}
    taken = set()
    if dots or "@" in text or "%40" in text or any(b in text for b in "[({<"):
        ats = [m.span() for m in _SOFT_AT.finditer(text)]
        hard = [(k, k + 1) for k in _plain_ats(text)] if dots else []
        soft, before_end = set(ats), 0
        for a, b in sorted({*ats, *hard}):
            floor, before_end = before_end, b
            host, joined = _host(text, b, starts)
            bare = (a, b) in soft and not _SURE_AT.search(text, a, b)
            disguised = [d for d in joined if d is not None]
            if host is None or (bare and (len(disguised) < len(joined))):
                continue
            if (a, b) not in soft and None in joined:     # a plain address, plain words behind it
                disguised = disguised if joined[0] is not None else []
            before = _name(text, a, floor, ends)
            if before is None:
                continue
            if (a, b) in soft:
                out.append((a, b, "@"))
            elif not disguised and not before:
                continue
            taken.update(disguised, before)
    for a, b in dots:                                     # between four numbers
        if (a, b) not in taken:
            taken.update(_quad(text, a, starts) or ())
    out += [(a, b, ".") for a, b in taken]
    out.sort()
    kept, end = [], 0
    for e in out:
        if e[0] >= end:
            kept.append(e)
            end = e[1]
    return kept


def _plain_ats(text: str) -> Iterator[int]:
    at = text.find("@")
    while at >= 0:
        yield at
        at = text.find("@", at + 1)


def _host(text: str, at: int, dots: dict) -> tuple[int | None, list]:
    """End of the host that starts at ``at``, if it has two labels, and the dots that join it: None
    for a plain one, the span of a disguised one."""
    joined, end = [], None
    while m := _LABEL.match(text, at):
        if joined:
            end = m.end()
        at = m.end()
        if text.startswith(".", at) and not any(d is not None for d in joined):
            joined.append(None)
            at += 1
        elif at in dots:
            joined.append((at, dots[at]))
            at = dots[at]
        else:
            return end, joined
    return end, joined[:-1]


def _run_back(text: str, at: int, floor: int) -> int:
    """Length of the run of local characters that ends at ``at``, not beyond ``floor``."""
    size = 64
    while True:
        low = max(floor, at - size)
        m = _LOCAL.match(text[low:at][::-1])
        if not m or m.end() < at - low or low == floor:
            return m.end() if m else 0
        size *= 4


def _name(text: str, at: int, floor: int, dots: dict) -> list | None:
    """Disguised dots of the name that ends at ``at``; None without a name."""
    found, n = [], _run_back(text, at, floor)
    if not n:
        return None
    while n and at - n in dots:
        found.append((dots[at - n], at - n))
        at = dots[at - n]
        n = _run_back(text, at, floor)
    return found if n else found[:-1]


def _quad(text: str, at: int, dots: dict) -> list | None:
    """The dots of the first of ``a.b.c.d`` on, if four numbers are joined from there and at least
    one more than this dot is not plain or all are."""
    k = at
    while k > 0 and text[k - 1] in "0123456789" and at - k < 20:
        k -= 1
    if k == at:
        return None
    found, plain_ = [], 0
    for _ in range(3):
        if at in dots:
            found.append((at, dots[at]))
            at = dots[at]
        elif text.startswith(".", at):
            plain_ += 1
            at += 1
        else:
            return None
        m = _DIGITS.match(text, at)
        if not m:
            return None
        at = m.end()
    return found


TRANSDUCERS = (character_edits, digit_edits, sign_edits)


class Rewritten:
    """A text after some edits, and the way back to its places before them."""

    def __init__(self, text: str, edits: list):
        parts, at, shift = [], 0, 0
        self.starts, self.ends, self.sources = [], [], []
        for a, b, new in edits:
            parts += [text[at:a], new]
            self.starts.append(a + shift)
            self.ends.append(a + shift + len(new))
            self.sources.append((a, b))
            shift += len(new) - (b - a)
            at = b
        self.text = "".join([*parts, text[at:]])

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The place before the edits of what now is at ``start`` to ``end``."""
        k = bisect.bisect_right(self.starts, start) - 1     # the last edit that begins by then
        first = (start if k < 0 else self.sources[k][0] if start < self.ends[k]
                 else self.sources[k][1] + start - self.ends[k])
        k = bisect.bisect_left(self.starts, end) - 1
        last = (end if k < 0 else self.sources[k][1] if end <= self.ends[k]
                else self.sources[k][1] + end - self.ends[k])
        return first, last


def find(text: str) -> tuple[list, list]:
    """Base spans and added spans of ``text`` as ``(kind number, start, end)``."""
    base = [(k, a, b) for k, detect in enumerate(DETECTORS) for a, b in detect(text)]
    now, steps = text, []
    for transduce in TRANSDUCERS:
        edits = transduce(now)
        if edits:
            steps.append(Rewritten(now, edits))
            now = steps[-1].text
    if not steps:
        return base, []
    own = [sorted(x[1:] for x in base if x[0] == k) for k in range(len(KINDS))]
    added = []
    for k, detect in enumerate(DETECTORS):
        for a, b in detect(now):
            first, last = a, b
            for step in reversed(steps):
                first, last = step.back(first, last)
            if text[first:last] == now[a:b]:
                continue
            j = bisect.bisect_right(own[k], (first, len(text) + 1)) - 1
            if j < 0 or own[k][j][1] < last:
                added.append((k, first, last))
    return base, added


def _joined(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, base, added`` of every row: spans ``kind, start, end`` in code points, end
    exclusive, by kind as listed and start."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            found = [find(t or "") for t in batch.column(1).to_pylist()]
            lists = [pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(f[i])]
                               for f in found], pa.list_(span)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["doc_id", "base", "added"])

    spans = "array<struct<kind:string,start:long,end:long>>"
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, base {spans}, added {spans}")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    both = F.transform(F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        rank(s).alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
        s["kind"].alias("kind")))), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(text(F.col("base")), 256).alias("base_sha256"),
                        text(both).alias("spans"))
