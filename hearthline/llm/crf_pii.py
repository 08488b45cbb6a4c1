r"""Personal data: patterns, and a linear-chain conditional random field over word shapes that adds spans.

Patterns find mail addresses, IP addresses, card numbers and phone numbers; all their finds stay. The field
adds spellings that the patterns miss (phone numbers without a plus, spelt-out mail addresses, ...). It is
trained in a second from a small labelled table (`labelled_table`, made by a rule), and decoded by Viterbi
over numpy batches. A chain is a stretch of tokens around a trigger (a digit, an @, "dot", "at" in brackets or
before a hyphen, or a plain "at" whose next word has a dot behind it); every span that `plausible` accepts holds
a trigger. Tokens further than REACH characters from any trigger are outside by definition, so plain prose costs
one scan. A span of the field counts if its digits or parts can be of its kind and no pattern's span meets it.

Offsets are code points, ends exclusive. Patterns are matched leftmost and without overlap within a kind:
for addresses the search starts at each @ resp. at the first digit of a run, which gives the same matches as
trying every start, in linear time for texts of any length.

Defined cases: null and empty texts have no spans; repeated rows are searched each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hearthline.llm.common import buffers, sha, slices, text_bytes
from hearthline.llm.crf import LinearChainCRF

KINDS = ["email", "ip", "card", "phone"]
Span = tuple[int, int, int]  # start, number of the kind, end

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(twice)) % 10 == 0


def pattern_spans(text: str) -> list[Span]:
    """The finds of the four patterns, by start and kind."""
    out: list[Span] = []
    ended, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > ended and _LOCAL.match(text[begin - 1]):
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at)):
            out.append((begin, 0, m.end()))
            ended = m.end()
        at = text.find("@", max(at + 1, ended))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for kind, pattern, least, most in ((2, _CARD, 14, 19), (3, _PHONE, 10, 15)):
        for m in pattern.finditer(text):
            digits = "".join(_DIGITS.findall(m[0]))
            if least <= len(digits) <= most and (kind != 2 or luhn(digits)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


# --- word shapes -----------------------------------------------------------------------------------------

_TOKEN = re.compile(r"[0-9]+|[^\W0-9_]+|\S")
_TRIGGER = re.compile(r"[0-9]+|@|\bdot\b|[\[({]\s?at\s?[\])}]|\bat-|\bat\s[\w-]++\s?\.[\w-]", re.I)
#: In UTF-8, what every text with a trigger has: digits, @, "dot", or "at" before a space, a hyphen or a bracket.
_MAYBE = re.compile(rb"[0-9@]|\b[dD][oO][tT]\b|\b[aA][tT][-\])}\s\x1c-\x1f\x80-\xff]")
REACH = 60
# Words and signs with a shape of their own.
WORD_SHAPES = {
    "at": "at", "dot": "dot", "com": "tld", "org": "tld", "net": "tld", "edu": "tld",
    "call": "call", "phone": "call", "tel": "call", "mobile": "call", "fax": "call", "dial": "call",
    "mail": "write", "email": "write", "contact": "write", "write": "write",
    "ip": "host", "host": "host", "server": "host", "address": "host",
    "card": "pay", "visa": "pay", "credit": "pay", "paid": "pay",
    "version": "number", "v": "number", "page": "number", "order": "number", "id": "number", "token": "number",
}
SIGNS = "+-().@[]{}:/,_=#\"'"
SHAPES = ["none", *(f"d{n}" for n in ("1", "2", "3", "4", "5", "7", "10", "13")), "lower", "capital", "upper", "other", "sign", *dict.fromkeys(WORD_SHAPES.values()), *SIGNS]
SHAPE = {s: i for i, s in enumerate(SHAPES)}
OFFSETS = (-3, -2, -1, 0, 1, 2, 3)
KEYWORDS = [SHAPE[s] for s in ("call", "write", "host", "pay", "number")]
N_FEATURES = len(OFFSETS) * len(SHAPES) + len(KEYWORDS) + 2
OUTSIDE = len(KINDS)


@lru_cache(100_000)
def shape(token: str) -> int:
    if "0" <= token[0] <= "9":
        return SHAPE[next(s for n, s in ((13, "d13"), (10, "d10"), (7, "d7"), (5, "d5"), (4, "d4"), (3, "d3"), (2, "d2"), (1, "d1")) if len(token) >= n)]
    if token in SIGNS:
        return SHAPE[token]
    if not token[0].isalpha():
        return SHAPE["sign"]
    if token.lower() in WORD_SHAPES:
        return SHAPE[WORD_SHAPES[token.lower()]]
    return SHAPE["lower" if token.islower() else "upper" if token.isupper() else "capital" if token[1:].islower() else "other"]


Token = tuple[int, int, str]


def tokens(text: str, begin: int, end: int) -> list[Token]:
    return [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(text, begin, end)]


def chains(text: str) -> list[list[Token]]:
    """Tokens of the stretches around triggers; stretches that touch are one."""
    spans: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if spans and a <= spans[-1][1]:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    found = (tokens(text, a, b) for a, b in spans)
    return [t for t in found if t]


def feature_rows(sequences: list[list[Token]]) -> tuple[np.ndarray, np.ndarray]:
    """Column numbers of the features that each token has, -1 for none [tokens, ...], and where the sequences begin."""
    sizes = np.array([len(s) for s in sequences])
    begins = np.cumsum(sizes) - sizes
    shapes = np.array([shape(t[2]) for s in sequences for t in s])
    tight = np.array([i > 0 and s[i - 1][1] == t[0] for s in sequences for i, t in enumerate(s)])
    place = np.arange(len(shapes)) - np.repeat(begins, sizes)
    rest = np.repeat(sizes, sizes) - place
    columns = []
    for k, off in enumerate(OFFSETS):
        inside = (place + off >= 0) & (off < rest)
        neighbour = np.where(inside, shapes[np.clip(np.arange(len(shapes)) + off, 0, len(shapes) - 1)], 0)
        columns.append(k * len(SHAPES) + neighbour)
    base = len(OFFSETS) * len(SHAPES)
    for k, word in enumerate(KEYWORDS):
        hits = np.cumsum(np.append(0, shapes == word))
        near = hits[np.arange(len(shapes)) + 1] - hits[np.maximum(np.arange(len(shapes)) - 6, np.repeat(begins, sizes))]
        columns.append(np.where(near > 0, base + k, -1))
    columns.append(np.where(tight, base + len(KEYWORDS), base + len(KEYWORDS) + 1))
    return np.stack(columns, axis=1), begins


# --- training --------------------------------------------------------------------------------------------


def labelled_table(rows: int = 500, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """Sentences with marked personal data, made by a rule: a template, filler words, numbers."""
    rng = random.Random(seed)
    syllables = ["an", "ter", "on", "the", "ré", "ung", "ción", "en", "ou", "st", "lich", "ar"]

    def word() -> str:
        w = "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
        return w.capitalize() if rng.random() < 0.2 else w

    def digits(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def mail() -> str:
        at, dot = rng.choice([(" at ", " dot "), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), ("(at)", "(dot)"), (" at ", "."), ("@", ".")])
        name = word().lower() + rng.choice(["", digits(2), dot + word().lower()])
        return f"{name}{at}{word().lower()}{dot}{rng.choice(['com', 'org', 'net'])}"

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}){b}-{c}", f"00{digits(2)} {a} {b} {c}", f"+{digits(1)} ({a}) {b}-{c}", f"1-{a}-{b}-{c}"])

    def ip() -> str:
        sep = rng.choice([" . ", "[.]", "(.)", "."])
        return sep.join(str(rng.randint(0, 255)) for _ in range(4))

    def card() -> str:
        sep = rng.choice([".", "/", "_"])
        return sep.join(digits(4) for _ in range(4))

    def other() -> str:
        hexa = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([8, 32, 40])))
        return rng.choice([
            f"{rng.randint(1900, 2030)}", f"{rng.randint(1, 12)}.{rng.randint(0, 99)}", f"version {rng.randint(1, 9)}.{rng.randint(0, 9)}.{rng.randint(0, 9)}",
            f"{rng.randint(1, 28)}/{rng.randint(1, 12)}/{rng.randint(1990, 2030)}", f"{rng.randint(1990, 2030)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}",
            f'token = "{hexa}"', f"order {digits(rng.randint(5, 12))}", f"{digits(rng.randint(1, 6))}", f"{digits(2)}:{digits(2)}:{digits(2)}", f"${digits(3)}.{digits(2)}",
            f"page {digits(3)}", f"{word()}{digits(2)}", f"{digits(2)}-{digits(2)}", f"at {word()}", f"{word()} dot {word()}", f"Version {rng.randint(1, 4)}.0.",
            f"CC BY-NC {rng.randint(1, 4)}.0.", digits(16), f"a dot on the {word()}", f"{digits(3)}, {digits(3)}, {digits(4)}",
        ])

    makers = [mail, ip, card, phone]
    lead = [["mail", "write to", "contact", ""], ["host", "server", "IP", ""], ["card", "paid by", "visa", ""], ["call", "tel", "phone", ""]]
    table = []
    for i in range(rows):
        text, spans = " ".join(word() for _ in range(rng.randint(1, 6))) + " ", []
        for part in range(rng.randint(1, 3)):
            if (i + part) % 3:
                text += other()
            else:
                kind = rng.randrange(4)
                text += rng.choice(lead[kind]) + " "
                made = makers[kind]()
                spans.append((len(text), kind, len(text) + len(made)))
                text += made
            between = rng.choice([" or ", " and ", ", ", " / ", " ".join(["", *(word() for _ in range(rng.randint(1, 6))), ""])])
            text += rng.choice(["", ".", ","]) + between
        table.append((text, spans))
    return table


def train_pii_model(table: list[tuple[str, list[Span]]]) -> LinearChainCRF:
    sequences = [s for text, _ in table if (s := tokens(text, 0, len(text)))]
    marks = [spans for text, spans in table if tokens(text, 0, len(text))]
    columns, begins = feature_rows(sequences)
    lengths = np.array([len(s) for s in sequences])
    x = np.zeros((len(sequences), lengths.max(), N_FEATURES), np.float32)
    y = np.full(x.shape[:2], OUTSIDE)
    for i, (s, spans) in enumerate(zip(sequences, marks)):
        for t, (a, b, _) in enumerate(s):
            c = columns[begins[i] + t]
            x[i, t, c[c >= 0]] = 1
            y[i, t] = next((kind for start, kind, end in spans if start <= a and b <= end), OUTSIDE)
    return LinearChainCRF.train(x, y, lengths, len(KINDS) + 1, steps=100, l2=1e-5)


# --- decoding --------------------------------------------------------------------------------------------


def decode(model: LinearChainCRF, sequences: list[list[Token]]) -> list[list[Span]]:
    """The spans of each sequence on its Viterbi path."""
    if not sequences:
        return []
    columns, begins = feature_rows(sequences)
    weights = np.vstack([model.emission, np.zeros(model.emission.shape[1])])
    states = model.viterbi(weights[columns].sum(axis=1), begins).tolist()
    out = []
    for s, begin in zip(sequences, begins.tolist()):
        spans: list[Span] = []
        before = OUTSIDE
        for (a, b, _), state in zip(s, states[begin : begin + len(s)]):
            if state != OUTSIDE:
                if state == before:
                    spans[-1] = (spans[-1][0], state, b)
                else:
                    spans.append((a, state, b))
            before = state
        out.append(spans)
    return out


_DOT = r"[\[({]?\s?\bdot\b\s?[\])}]?"
#: Behind a plain "at", a dot with a space after it ends a sentence ("we met at home. Then").
_ADDRESS = re.compile(
    r"[\w.+-]+(?:\s?[\[({]?\s?dot\s?[\])}]?\s?[\w+-]+)*\s?"
    rf"(?:(?:@|[\[({{]\s?at\s?[\])}}])\s?[\w-]+(?:\s?(?:\.|{_DOT})\s?[\w-]+)+|\bat\b\s?[\w-]+(?:\s?(?:\.(?!\s)|{_DOT})\s?[\w-]+)+)",
    re.I,
)
_PLAIN_AT = re.compile(r"(?<![\[({])(?<![\[({]\s)\bat\b", re.I)
_SENTENCE_END = re.compile(r"\.\s")


def trimmed(text: str, span: Span) -> Span:
    """The span; of an address with a plain "at" what is before the end of the sentence."""
    start, kind, end = span
    if kind == 0 and (at := _PLAIN_AT.search(text, start, end)) and (stop := _SENTENCE_END.search(text, at.end(), end)):
        return start, kind, stop.start()
    return span


def plausible(text: str, span: Span) -> bool:
    """Whether the text of a span of the field can be of its kind."""
    start, kind, end = span
    part = text[start:end]
    digits = _DIGITS.findall(part)
    if kind == 0:
        return bool(_ADDRESS.fullmatch(part)) and "\n" not in part
    if kind == 1:
        octets = re.findall(r"[0-9]+", part)
        return len(octets) == 4 and all(len(o) <= 3 and int(o) <= 255 for o in octets)
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn("".join(digits)) and "\n" not in part
    return 10 <= len(digits) <= 15 and "\n" not in part and not re.fullmatch(r"[0-9]+", part)


def find_spans(model: LinearChainCRF, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """For each text the pattern's spans and those that the field adds."""
    found = [chains(t) for t in texts]
    decoded = iter(decode(model, [s for sequences in found for s in sequences]))
    out = []
    for text, sequences in zip(texts, found):
        base = pattern_spans(text)
        more = [span for _ in sequences for span in next(decoded)]
        added, i = [], 0
        reach, limits = 0, []
        for start, _, end in base:
            reach = max(reach, end)
            limits.append((start, reach))
        starts = [a for a, _ in limits]
        for span in (trimmed(text, s) for s in more):
            i = int(np.searchsorted(starts, span[2])) - 1
            if (i < 0 or limits[i][1] <= span[0]) and plausible(text, span):
                added.append(span)
        out.append((base, added))
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span (spans that overlap: the whole of them) replaced by the name of its kind."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


COUNTS = [f"n_{k}" for k in KINDS]


def find_personal_data(docs: DataFrame, carry: list[str] | None = None, table: list[tuple[str, list[Span]]] | None = None, with_text: bool = False) -> DataFrame:
    """The `carry` columns (default: doc_id), counts of the patterns' finds, n_added, base_sha256, spans; if wanted, redacted_text."""
    carry = carry or ["doc_id"]
    model = train_pii_model(table or labelled_table())
    picked = docs.select(*dict.fromkeys([*carry, "text"]))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.select(*carry).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in slices(batches):
            raw = text_bytes(*buffers(column))
            some = [i for i, t in enumerate(raw) if _MAYBE.search(t)]
            texts = [raw[i].decode() for i in some]
            found = dict(zip(some, find_spans(model, texts)))
            whole = dict(zip(some, texts))
            rows = [found.get(i, ([], [])) for i in range(len(raw))]
            counts = [pa.array([sum(s[1] == k for s in base) for base, _ in rows], pa.int64()) for k in range(len(KINDS))]
            columns = [batch.column(c) for c in carry] + counts + [
                pa.array([len(added) for _, added in rows], pa.int64()),
                pa.array([sha(written(base)) for base, _ in rows], pa.string()),
                pa.array([written(base + added) for base, added in rows], pa.string()),
            ]
            if with_text:
                clean = (redacted(whole[i], base + added) if base or added else raw[i].decode() for i, (base, added) in enumerate(rows))
                columns.append(pa.array(list(clean), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    figures = ", ".join(f"{c} long" for c in [*COUNTS, "n_added"])
    schema = f"{kept}, {figures}, base_sha256 string, spans string" + ", redacted_text string" * with_text
    names = [*carry, *COUNTS, "n_added", "base_sha256", "spans"] + ["redacted_text"] * with_text
    return picked.mapInArrow(run, schema)
