"""Personal data: patterns for plain forms, and a character tagger that adds disguised ones."""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, materialize
from .tagger import Tagger, codes

KINDS = ("email", "ip", "card", "phone")
#: Characters of a window, how far windows are apart, and context kept beside what may be personal data.
WINDOW, STEP, MARGIN = 96, 48, 40
#: Labelled windows: made ones, and at most so many read from the corpus.
MADE, SAMPLE_MAX, EPOCHS = 2400, 800, 8
#: Characters of the longest address.
EMAIL_MAX = 254
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: What stands for the marks of an address: an @, or a bracketed at; a spelled at counts with a spelled dot after it.
_AT = re.compile(r"@|[\[({<] ?at ?[\])}>]", re.IGNORECASE)
_SPELLED_AT = re.compile(r"\sat\s", re.IGNORECASE)
_DOT = re.compile(r"\.|[\[({<] ?dot ?[\])}>]|\sdot\s", re.IGNORECASE)
_SPELLED_DOT = re.compile(r"[\[({<] ?dot ?[\])}>]|\sdot\s", re.IGNORECASE)
#: Every span that passes its check (plausible) holds one of these, so text far from them can hold none: windows are
#: laid around them and leave out no span.
_TRIGGER = re.compile(r"[0-9@]|[\[({<] ?(?:at|dot) ?[\])}>]|\sdot\s", re.IGNORECASE)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each kind that pass its check, kinds in order."""
    out: list[Span] = []
    end = 0
    at = text.find("@")
    while at >= 0:  # the run before an @ is the only place where a match of it can begin
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    for kind, pattern, good in (
        ("ip", _IP, lambda s: all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in s.split("."))),
        ("card", _CARD, lambda s: 13 <= len(d := digits_of(s)) <= 19 and luhn(d)),
        ("phone", _PHONE, lambda s: 9 <= len(digits_of(s)) <= 15),
    ):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if good(m[0])]
    return out


TAGS = ["O", *(f"{b}-{k}" for k in KINDS for b in "BI")]


def allowed_moves() -> np.ndarray:
    """I follows B or I of its kind only."""
    return np.array([[not b.startswith("I") or a[2:] == b[2:] for b in TAGS] for a in TAGS])


def labels_of(spans: list[Span], start: int) -> np.ndarray:
    y = np.zeros(WINDOW, dtype=np.int64)
    for kind, a, b in spans:
        a, b = max(a - start, 0), min(b - start, WINDOW)
        if a < b:
            y[a:b] = TAGS.index(f"I-{kind}")
            y[a] = TAGS.index(f"B-{kind}")
    return y


def made_windows(n: int = MADE, seed: int = 0) -> list[tuple[str, list[Span]]]:
    """Labelled windows: invented personal data, plain and disguised, and look-alikes, among invented words."""
    r = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda a=1, b=9: "".join(r.choice(letters + "éüß" * (r.random() < 0.05)) for _ in range(r.randint(a, b)))
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))

    def email() -> str:
        at, dot = r.choice([("@", "."), ("@", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), ("(at)", "."), (" at ", " (dot) "), (" at ", " dot "), (" At ", " Dot "), ("{at}", "{dot}"), (" @ ", ".")])
        local = r.choice([".", "_", "-", "."]).join(word(1, 7) for _ in range(r.choice([1, 1, 2, 2, 3]))) + r.choice(["", "", digits(1), digits(2)])
        host = word(3, 8) + r.choice(["", "", digits(1), f"-{word(2, 9)}"])
        names = [*([r.choice(["mail", "example", word(3, 6)])] if r.random() < 0.4 else []), host]
        return local + at + dot.join([*names, r.choice(["com", "org", "net", "de", "io", "edu", "fr", "co", word(2, 3)])])

    def ip() -> str:
        return r.choice([".", ".", ".", "[.]", " . ", "(.)"]).join(str(r.randint(0, 255)) for _ in range(4))

    def card() -> str:
        d = r.choice("3456") + digits(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        return r.choice(["", "", " ", "-", ".", "/", "_", "  "]).join(d[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return r.choice([f"+1 ({a}) {b}-{c}", f"+{digits(2)} {a} {b}{c}", f"+{digits(2)}{a}{b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"00{digits(2)} {a} {b} {c}", f"1-{a}-{b}-{c}", f"{a}.{b}.{c}"])

    def other() -> str:
        return r.choice([digits(r.randint(1, 6)), f"{digits(1)}.{digits(1)}", f"{digits(2)}.{digits(2)}.{digits(4)}", f"{digits(4)}-{digits(2)}-{digits(2)}", "".join(r.choice("0123456789abcdef") for _ in range(40)), f'= "{digits(3)}{word()}{digits(3)}"', f"{digits(2)}:{digits(2)}", "AK" + "".join(r.choice("ABCDEFGHJK0123456789") for _ in range(18)), f"{digits(4)} (at)", f"v{digits(1)}.{digits(1)}.{digits(2)}", f"{digits(1)} at {word()}.", f"@{word()}", f"{word()} at {word()}. {digits(2)}"])

    out = []
    for _ in range(n):
        text, spans, size = "", [], r.randint(30, WINDOW)
        while len(text) < size:
            kind = r.random()
            if kind < 0.22:
                k = r.choice(KINDS)
                x = {"email": email, "ip": ip, "card": card, "phone": phone}[k]()
                spans.append((k, len(text), len(text) + len(x)))
                text += x
            else:
                text += other() if kind < 0.3 else word().capitalize() if kind < 0.4 else word()
            text += r.choice([" ", " ", " ", ", ", ". ", "\n"])
        cut = r.randint(0, 12) if r.random() < 0.3 else 0
        out.append((text[cut : cut + WINDOW], [(k, a - cut, b - cut) for k, a, b in spans]))
    return out


def windows_of(text: str) -> list[int]:
    """Starts of the overlapping windows that cover every trigger with a margin."""
    out: list[int] = []
    runs: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        if runs and m.start() - MARGIN <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], min(len(text), m.end() + MARGIN))
        else:
            runs.append([max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)])
    for a, b in runs:
        out += range(a, max(a + 1, b - WINDOW + STEP), STEP)
    return out


def plausible(kind: str, s: str) -> bool:
    """The exact check that an added span must pass."""
    d = digits_of(s)
    if kind == "email":
        at = _AT.search(s)
        dot = _DOT.search(s, at.end()) if at else None
        if not dot:
            at = _SPELLED_AT.search(s)
            dot = _SPELLED_DOT.search(s, at.end() - 1) if at else None
        return bool(at and dot and at.start() > 0 and s[0].isalnum() and s[-1].isalnum() and len(s) <= EMAIL_MAX)
    if kind == "ip":
        parts = re.findall(r"[0-9]+", s)
        return len(parts) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in parts) and s[:1].isdigit() and s[-1:].isdigit()
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d) and not re.search(r"[^\W\d_]", s)
    return 9 <= len(d) <= 15 and len(re.findall(r"[0-9]+", s)) >= 3 and not re.search(r"[^\W\d_]", s) and s[-1:].isdigit()


class PiiModel:
    """A tagger trained on labelled windows; deterministic."""

    def __init__(self, windows: list[tuple[str, list[Span]]], epochs: int = EPOCHS):
        self.tagger = Tagger(len(TAGS), allowed_moves())
        x = np.stack([codes(w, WINDOW) for w, _ in windows])
        y = np.stack([labels_of(s, 0) for _, s in windows])
        self.losses = self.tagger.train(x, y, epochs)

    def spans(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """For each text its base spans, and all spans: the tagger's added where they meet no other."""
        base = [base_spans(t) for t in texts]
        places = [(k, a) for k, t in enumerate(texts) for a in windows_of(t)]
        found: list[list[Span]] = [[] for _ in texts]
        for at in range(0, len(places), 512):
            some = places[at : at + 512]
            tags = self.tagger.decode(np.stack([codes(texts[k][a : a + WINDOW], WINDOW) for k, a in some]))
            for (k, a), row in zip(some, tags, strict=True):
                found[k] += tag_spans(row, a, len(texts[k]))
        return [(b, reconciled(t, b, f)) for t, b, f in zip(texts, base, found, strict=True)]


def tag_spans(row: np.ndarray, start: int, end: int) -> list[Span]:
    out: list[Span] = []
    at = 0
    while at < len(row):
        if row[at]:
            kind, b = TAGS[row[at]][2:], at + 1
            while b < len(row) and TAGS[row[b]] == f"I-{kind}":
                b += 1
            out.append((kind, start + at, min(end, start + b)))
            at = b
        else:
            at += 1
    return [s for s in out if s[1] < s[2]]


def joined(found: list[Span]) -> list[Span]:
    """The spans, and for spans of one kind that overlap or touch, as neighbouring windows cut them, the whole they make up."""
    out = set(found)
    for kind in KINDS:
        run: Span | None = None
        for _, a, b in sorted(s for s in out if s[0] == kind):
            if run and a <= run[2]:
                run = (kind, run[1], max(run[2], b))
            else:
                run = (kind, a, b)
            out = out | {run}
    return sorted(out, key=lambda s: (s[1] - s[2], s[1], s[0]))


def reconciled(text: str, base: list[Span], found: list[Span]) -> list[Span]:
    """Base spans, and those found in any window that pass their check: the longest first, none overlapping another."""
    kept, taken = list(base), sorted((a, b) for _, a, b in base)
    for kind, a, b in joined(found):
        k = bisect.bisect_left(taken, (a, b))
        clear = (k == 0 or max(e for _, e in taken[max(0, k - 4) : k]) <= a) and (k == len(taken) or taken[k][0] >= b)
        if clear and plausible(kind, text[a:b]):
            kept.append((kind, a, b))
            bisect.insort(taken, (a, b))
    return kept


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def fit(docs: DataFrame | None = None, text_col: str = "text", sample_max: int = SAMPLE_MAX, epochs: int = EPOCHS) -> PiiModel:
    """Train on made windows and on at most sample_max windows of the corpus, labelled by the patterns.

    The windows are cut where the texts are read and chosen by their hash, so
    the driver gets a bounded number of short strings.
    """
    windows = made_windows()
    if docs is not None:

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = {t[a : a + WINDOW] for t in b.column(0).to_pylist() if t for a in windows_of(t)}
                yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["w"])

        rows = docs.select(text_col).mapInArrow(cut, "w string")
        windows += [(r.w, base_spans(r.w)) for r in hash_sample(materialize(rows.distinct(), "pii-windows"), sample_max, "w").collect()]
    return PiiModel(windows, epochs)


def detected(docs: DataFrame, model: PiiModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) of every row: lists of kind, start, end in code points, end exclusive; no shuffle.

    Null texts are empty; repeated rows give repeated rows; an empty table none.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = model.spans([t or "" for t in b.column(1).to_pylist()])
            lists = [pa.array([[{"kind": k, "start": a, "end": e} for k, a, e in s] for s in side], item) for side in (zip(*both, strict=True) if both else ([], []))]
            yield pa.RecordBatch.from_arrays([b.column(0), *lists], names=[id_col, "base", "spans"])

    span = "array<struct<kind: string, start: bigint, end: bigint>>"
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, base {span}, spans {span}")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind."""
    for kind, a, b in sorted(spans, key=lambda s: -s[1]):
        text = f"{text[:a]}<{kind}>{text[b:]}"
    return text


def sha256_hex(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()
