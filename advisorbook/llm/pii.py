"""Personal data, also where it is disguised, at its place in the source text.

Base spans come from the text as it is. The method adds spans: a chain of transducers
rewrites a text (homoglyphs to ASCII, spelled digits to digits, at/dot disguises to signs)
and keeps for each piece of its output the piece of source it came from; the detectors then
run over the normalised forms and their spans are mapped back. An added span never replaces
a base span and never lies inside one of its kind. No text is spared a transducer
by a look that knows less than it does, so what is found never depends on unrelated text.

An added span is certain or unsure. Prose holds what some disguises look like ("look at
example.com", "version 1 . 2 . 3 . 4", "+49 151 2345678 acht Leute"); such readings are kept as
spans and told apart, and ``mask`` leaves them alone (see ``is_certain``). Base spans are certain.

Offsets are code points, ends exclusive. A null text is empty. Rows are read one by one, so
repeated rows and further columns change nothing; an empty table gives no rows. Every
detector passes over a text once, however long it is.
"""

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from advisorbook.llm.common import column

# Kinds in the order that settles equal starts.
KINDS = ("email", "ip", "card", "phone")

# Letters of other scripts that look like ASCII ones.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "ӏ": "l", "ԛ": "q", "ԝ": "w", "к": "k", "т": "t", "м": "m", "в": "b", "н": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "Ѕ": "S",
    "І": "I", "Ј": "J", "У": "Y", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ɑ": "a",
    "。": ".", "․": ".", "﹒": ".", "｡": ".", "﹫": "@", "＠": "@", "．": ".", "＋": "+", "﹢": "+", "－": "-", "‐": "-", "‑": "-",
    "‒": "-", "–": "-", "−": "-", " ": " ", " ": " ", " ": " ", " ": " ", "　": " ",
}

# Characters that show nothing.
INVISIBLE = "­​‌‍⁠﻿"

# Digits in words, English, German, French and Spanish.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
    "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8",
    "nueve": "9",
}

AT_WORDS = "at|arobase|arroba|ät"
DOT_WORDS = "dot|punkt|point|punto"

# Top-level labels besides those of two letters, which are all countries'.
TOP_LABELS = frozenset(
    "com org net edu gov mil int info biz name pro dev app xyz online site tech cloud email test example".split()
)
# Two-letter labels that are English words, no sign of an address behind a spelled dot.
WORD_LABELS = frozenset("am as at be by do in is it me my no so to us".split())

Span = tuple[str, int, int]

_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str) -> Iterator[Span]:
    """From sign to sign, so that long runs of letters are not tried at every start."""
    end, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < sign and (domain := _DOMAIN.match(text, sign)):
            end = domain.end()
            yield "email", start, end
        else:
            end = max(end, sign)
        sign = text.find("@", max(end, sign + 1))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0") or "0"
    return len(part) <= 3 and int(part) <= 255


def detect(text: str) -> list[Span]:
    """Base spans, by start, then kind."""
    spans = list(_emails(text))
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(map(_byte, m[0].split("."))):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


class Tracked:
    """A text made from a source, with the source range of each of its pieces."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.at, self.pieces = [0], [(0, len(text), False)]

    def edit(self, edits: list[tuple[int, int, str]]) -> "Tracked":
        """Replace the given ranges, which are in order and apart."""
        if not edits:
            return self
        out, at, pieces, length = [], [], [], 0

        def add(piece: str, start: int, end: int, whole: bool) -> None:
            nonlocal length
            if piece:
                out.append(piece)
                at.append(length)
                pieces.append((start, end, whole))
                length += len(piece)

        def copy(start: int, end: int) -> None:
            """What lies between two edits, piece by piece."""
            while start < end:
                k = bisect_right(self.at, start) - 1
                stop = min(end, self.at[k + 1] if k + 1 < len(self.at) else len(self.text))
                first, last, whole = self.pieces[k]
                if not whole:
                    first += start - self.at[k]
                    last = first + stop - start
                add(self.text[start:stop], first, last, whole)
                start = stop

        done = 0
        for start, end, new in edits:
            copy(done, start)
            if start < end:
                add(new, *self.source(start, end), True)
            done = end
        copy(done, len(self.text))
        made = Tracked("".join(out))
        made.at, made.pieces = at or [0], pieces or [(0, 0, True)]
        return made

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source range behind a range of this text."""
        k, j = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        first, _, whole = self.pieces[k]
        _, last, last_whole = self.pieces[j]
        if not whole:
            first += start - self.at[k]
        if not last_whole:
            last = self.pieces[j][0] + end - self.at[j]
        return first, last


class _Fold(dict):
    """ASCII look-alike of a character, or the character itself."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        plain = HOMOGLYPHS.get(c)
        if plain is None:
            plain = unicodedata.normalize("NFKC", c) if unicodedata.category(c) in ("Lu", "Ll", "Nd") else c
            if unicodedata.category(c) == "Nd":
                plain = str(unicodedata.digit(c))
            if not (len(plain) == 1 and plain.isascii()):
                plain = c
        self[code] = plain
        return plain


_FOLD = _Fold()
_INVISIBLE = re.compile(f"[{INVISIBLE}]+")
_NUMBER = "|".join(sorted(SPELLED, key=len, reverse=True))
_SPELLED_RUN = re.compile(rf"(?<!\w)(?:(?:plus|\+)[ -]*)?(?! )(?:(?:{_NUMBER})(?:[ -]|, |\b(?= (?:{DOT_WORDS}) ))|[0-9]++[ -]?| (?:{DOT_WORDS}) ){{1,}}(?:(?:{_NUMBER})\b|[0-9]+)", re.I)
_SPELLED_WORD = re.compile(rf"(?:(?<![^\W\d])|(?<=plus))(?:{_NUMBER})(?!\w)", re.I)
_PLUS = re.compile(r"(?:plus|\+)[ -]*", re.I)
_LOWER_WORD = re.compile(_SPELLED_WORD.pattern)
# Letters that match "i" and "s" without regard to case.
_CASELESS = str.maketrans("İıſ", "iis")
_BRACKETS = re.compile(rf" ?[\[({{<] ?(?:(@|{AT_WORDS})|(\.|{DOT_WORDS})) ?[\])}}>] ?", re.I)
_DOMAIN_NAME = rf"[A-Za-z0-9-]++(?:(?: (?:{DOT_WORDS}) |\.|_dot_)[A-Za-z0-9-]++)++"
_AT_SIGN = rf"(?: (?:{AT_WORDS}) | ?@ ?|_at_)"
_ANY_AT_DOMAIN = re.compile(_AT_SIGN + _DOMAIN_NAME, re.I)
_AT_LABEL = re.compile("@[A-Za-z0-9-]")
_LOCAL_RUN = re.compile("[A-Za-z0-9._%+-]*")
_DOT_BEHIND = re.compile(rf" (?:{DOT_WORDS}) \Z", re.I)
_LONGEST_DOT = max(map(len, DOT_WORDS.split("|"))) + 2
_PLAIN_IP = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?: ?(?:\.|(?<= )(?:{DOT_WORDS})(?= )) ?[0-9]{{1,3}}){{3}}(?![0-9])", re.I)
_SIGNS = re.compile(rf"(?: (?:{AT_WORDS}) | ?@ ?|_at_)|( (?:{DOT_WORDS}) |_dot_)", re.I)
_DOTS = re.compile(rf" ?(?:\.|(?:{DOT_WORDS})) ?", re.I)
_DIGIT = re.compile("[0-9]")
# A sign that prose has as well: "at" or a sign with spaces around.
_PROSE_AT = re.compile(r" at | @|@ ", re.I)
_OTHER_AT = re.compile(r" (?:arobase|arroba|ät) ", re.I)
_SPELLED_DOT = re.compile(r" dot |_dot_", re.I)
_LIKE_LOCAL = re.compile(r"(?=.*[A-Za-z])(?:.*[0-9]|.*[A-Za-z0-9][._+][A-Za-z0-9])")
_EDGE_WORDS = re.compile(rf"(?:[ ,-]*(?:{_NUMBER})){{1,2}}\Z", re.I)
# Anything but ASCII and the letters of Latin scripts, which look like themselves.
_STRANGE = re.compile("[^\x00-\x7f\xa1-\xac\xae-\u0130\u0132-\u024f]")


def _has_number_word(text: str) -> bool:
    """Whether _SPELLED_WORD matches anywhere, sooner found in lower case."""
    return bool(_LOWER_WORD.search((text if text.isascii() else text.translate(_CASELESS)).lower()))


def _spelled(text: str) -> list[list[tuple[int, int, str]]]:
    """Digits for the words of runs, where the gaps between two words go.

    First for runs of three words or more; then, if there are any, also for runs of fewer words
    and numerals.
    """
    few, every = [], []
    for run in _SPELLED_RUN.finditer(text) if _has_number_word(text) else ():
        words = list(_SPELLED_WORD.finditer(text, *run.span()))
        if not words or len(words) < 3 and not _DIGIT.search(run[0]):
            continue
        edits = []
        if sign := _PLUS.match(text, run.start()):
            edits.append((*sign.span(), "+"))
        for w, after in zip(words, [*words[1:], None], strict=True):
            edits.append((*w.span(), SPELLED[w[0].translate(_CASELESS).lower()]))
            if after and w.end() < after.start() and text[w.end() : after.start()].strip(" ,-") == "":
                edits.append((w.end(), after.start(), ""))
            elif text.startswith(", ", w.end(), run.end()):
                edits.append((w.end(), w.end() + 2, " "))
        every += edits
        if len(words) >= 3:
            few += edits
    return [few] if few == every else [few, every]


def _at_domains(text: str, behind: re.Pattern) -> Iterator[re.Match]:
    """Signs with a domain; what ``behind`` follows is a local part and no domain ("me at john.doe@example.com")."""
    end, follows = -1, False
    for m in _ANY_AT_DOMAIN.finditer(text):
        if m.end() > end:
            end = _LOCAL_RUN.match(text, m.end()).end()
            follows = behind.match(text, end) is not None
        if not follows:
            yield m


def _spelled_dots(text: str, floor: int, end: int) -> list[tuple[int, int, str]]:
    """Dots for the dot words of the local part that ends at ``end``, seeking back to the sign before."""
    edits, at = [], end
    while True:
        while at > floor and text[at - 1] in _LOCAL_CHARS:
            at -= 1
        m = _DOT_BEHIND.search(text, max(floor, at - _LONGEST_DOT), at)
        if m is None or m.start() <= floor or text[m.start() - 1] not in _LOCAL_CHARS:
            return edits
        edits.append((*m.span(), "."))
        at = m.start()


def _signs(text: str) -> list[list[tuple[int, int, str]]]:
    """Signs for bare at and dot words, where an address or a number stands around them.

    Of several at words in a row, first the first is read, then, if there are any, the last.
    """
    numbers: list[tuple[int, int, str]] = []
    for m in _PLAIN_IP.finditer(text) if _DIGIT.search(text) else ():
        numbers += [(*s.span(), ".") for s in _DOTS.finditer(text, *m.span()) if s[0] != "."]
    if not _ANY_AT_DOMAIN.search(text):
        return [numbers]
    choices = []
    for behind in (_AT_LABEL, _ANY_AT_DOMAIN):
        edits, floor = list(numbers), 0
        for m in _at_domains(text, behind):
            if m.start() == 0 or text[m.start() - 1] not in _LOCAL_CHARS:
                continue
            edits += _spelled_dots(text, floor, m.start())
            floor = m.start()
            edits += [(*s.span(), "." if s[1] else "@") for s in _SIGNS.finditer(text, *m.span())]
        edits.sort()
        apart, done = [], 0
        for e in edits:
            if e[0] >= done:
                apart.append(e)
                done = e[1]
        if apart not in choices:
            choices.append(apart)
    return choices


def normalise(text: str) -> list[Tracked]:
    """The forms of the text without disguises, which differ from it and from one another.

    Numerals with one or two words among them are read in forms of their own, as a word behind a
    number may not belong to it. One form leaves bare signs as they are; of several at words in a
    row ("me at john.doe at example.com") the first and the last count, each in its form.
    """
    tracked = Tracked(text)
    if _STRANGE.search(text):
        tracked.text = text.translate(_FOLD)
        tracked = tracked.edit([(*m.span(), "") for m in _INVISIBLE.finditer(tracked.text)])
    forms = {text: None}
    for edits in _spelled(tracked.text):
        spelled = tracked.edit(edits)
        bare = spelled.edit([(*m.span(), "@" if m[1] else ".") for m in _BRACKETS.finditer(spelled.text)])
        for form in (spelled, *(bare.edit(e) for e in _signs(bare.text))):
            forms.setdefault(form.text, form)
    return [form for form in forms.values() if form is not None]


def is_certain(kind: str, shown: str, plain: str, beyond: str | None) -> bool:
    """Whether a disguised span is more than a way of putting ordinary prose.

    ``shown`` is the span in the source, ``plain`` its normal form, ``beyond`` what it has behind
    a base span of its kind at the same start, if there is one.

    * email: a bracketed, attached or look-alike sign is certain. A bare "at", or a sign among
      spaces, needs a lower-case domain with a known top-level label and either a local part with
      a digit or an inner dot, underscore or plus beside letters, or a spelled "dot".
    * ip: spaced or spelled dots need a part of three digits; bracketed dots and look-alikes none.
    * phone, card: one or two number words that only follow a numeral may count what comes next
      ("+49 151 2345678 acht Leute"). They are unsure behind a base span, and in a phone always;
      a card that is one only with them has its check digit for it.
    """
    folded = _BRACKETS.sub(lambda m: "@" if m[1] else ".", _INVISIBLE.sub("", shown.translate(_FOLD)))
    if kind == "email":
        local, _, domain = plain.partition("@")
        top = domain.rpartition(".")[2]
        known = domain == domain.lower() and (top in TOP_LABELS or len(top) == 2 and top.isalpha())
        if _OTHER_AT.search(folded):
            return known
        if not _PROSE_AT.search(folded):
            return True
        spelled = bool(_SPELLED_DOT.search(folded)) and top not in WORD_LABELS
        return known and (spelled or bool(_LIKE_LOCAL.match(local)))
    if kind == "ip":
        return " " not in folded or any(len(part) == 3 for part in plain.split("."))
    if beyond is not None:
        return not _EDGE_WORDS.fullmatch(beyond)
    if kind == "phone" and (edge := _EDGE_WORDS.search(folded)):
        return _has_number_word(folded[: edge.start()])
    return True


def graded(text: str) -> tuple[list[Span], dict[Span, bool]]:
    """Base spans, and all spans with whether each is certain; found twice, the surer reading counts."""
    base = detect(text)
    spans = dict.fromkeys(base, True)
    of_kind = {kind: [(start, end) for k, start, end in base if k == kind] for kind in KINDS}
    for plain in normalise(text):
        for kind, start, end in detect(plain.text):
            first, last = plain.source(start, end)
            k = bisect_right(of_kind[kind], first, key=lambda s: s[0]) - 1
            start_of_base, end_of_base = of_kind[kind][k] if k >= 0 else (-1, -1)
            if last <= end_of_base:
                continue
            span = (kind, first, last)
            if not spans.get(span, False):
                beyond = text[end_of_base:last] if start_of_base == first else None
                spans[span] = is_certain(kind, text[first:last], plain.text[start:end], beyond)
    return base, spans


def _in_order(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_all(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans with those found under disguises, unsure ones too."""
    base, spans = graded(text)
    return base, _in_order(spans)


def mask(text: str) -> str:
    """The text with each certain span replaced by its kind in angle brackets; overlapping spans as one."""
    out, done, open_kind, open_end = [], 0, None, 0
    certain = _in_order(span for span, sure in graded(text)[1].items() if sure)
    for kind, start, end in [*certain, ("", len(text) + 1, len(text) + 1)]:
        if open_kind is not None and start < open_end:
            open_end = max(open_end, end)
            continue
        if open_kind is not None:
            out.append(f"<{open_kind.upper()}>")
            done = open_end
        out.append(text[done:start])
        open_kind, open_end = kind, end
        done = start
    return "".join(out)


def mask_private(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The rows with their personal data masked; the length column, if any, follows the text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            at = names.index(text)
            old = batch.column(at).to_pylist()
            new = [t if t is None else mask(t) for t in old]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            if length in names:
                k = names.index(length)
                counts = [
                    n if a == b else len(b) for n, a, b in zip(batch.column(k).to_pylist(), old, new, strict=True)
                ]
                batch = batch.set_column(k, batch.schema.field(k), pa.array(counts, batch.schema.field(k).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_private(docs: DataFrame) -> DataFrame:
    """A row per document: base counts and digest, all spans, and those of them that are unsure."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [graded(t or "") for t in batch.column(1).to_pylist()]
            every = [joined(_in_order(s)) for _, s in found]
            unsure = [joined(_in_order(span for span, sure in s.items() if not sure)) for _, s in found]
            counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, *(pa.array(told, pa.string()) for told in (digests, every, unsure))],
                ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "unsure_spans"],
            )

    schema = "doc_id long, " + ", ".join(f"n_{kind} long" for kind in KINDS) + ", base_sha256 string, spans string, unsure_spans string"
    return docs.select(column("doc_id"), column("text")).mapInArrow(run, schema)
