"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes for what they miss.

The field is trained on the labelled sentences of pii_examples.py and decoded by Viterbi in numpy batches. Its features are shapes
(lengths of runs, separators, first and check digits) and the words around; only words that hold a digit or an at sign can be
personal data, so only lines with such words are decoded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, ship, slices, table
from .crf import Chain
from .pii_examples import training_table

#: Kinds of spans in the order in which they are listed; the last is found by the field alone.
KINDS = ("email", "ip", "card", "phone", "ssn")
LABELS = ("outside", *KINDS)
#: Words decoded and bytes of text taken at once in a task.
AT_ONCE, BYTES_AT_ONCE = 1 << 18, 1 << 21

_AT = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TRIGGER = re.compile(r"[0-9@]")
_WORD = re.compile(r"\S+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: from each at sign back over the characters of its local part, but not into the last match."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _AT.match(text, start) if start < at else None
        if m:
            out.append(m.span())
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    """Groups of four dotted numbers, from the left of each dotted run."""
    out = []
    for m in _DOTTED.finditer(text):
        parts, at = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[k:k + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts[k:k + 4]):
                out.append((at, at + size))
            at += size + 1
    return out


def cards(text: str) -> list[tuple[int, int]]:
    found = ((m.span(), _digits(m.group())) for m in _NUMBER.finditer(text))
    return [span for span, d in found if 16 <= len(d) <= 19 and luhn(d)]


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]


_BASE = tuple(zip(KINDS, (emails, addresses, cards, phones)))

# -- the field ---------------------------------------------------------------
_STRIP_LEFT, _STRIP_RIGHT = "\"'<[{`,;:", "\"'>]}`.,;:!?"
#: A feature of a word counts for the words this far behind it (negative: before it).
REACH = (0, 1, -1, 2, -2)
_MARKED = re.compile(r"[0-9@]")


def word_features(word: str) -> list[str]:
    """Shape of a word without quotes and closing marks: runs of digits and letters by length, separators, first digit, check digit.

    Words without digits and at signs are known by themselves; they only tell something of their neighbours.
    """
    w = word.lstrip(_STRIP_LEFT).rstrip(_STRIP_RIGHT)
    if not _MARKED.search(word):
        return [f"word {w.lower()}"]
    runs = re.findall(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]", w)
    lengths = [("d" if r[0].isdecimal() else "a") + str(min(len(r), 20)) if r[0].isalnum() else r for r in runs]
    digits = [len(r) for r in runs if r[0].isdecimal()]
    d = _digits(w)
    out = ["marked", f"digits {min(len(d), 20)}", f"groups {min(len(digits), 6)}"]
    out += ["shape " + "".join(lengths)] if len(runs) < 12 else []
    out += [f"mark {c}" for c in sorted(set(r for r in runs if not r[0].isalnum()))[:4]]
    out += [f"first {w[0]}"] if w and not w[0].isalnum() else []
    if any(r[0].isalpha() for r in runs):
        out.append("letters")
    if digits:
        out.append(f"last group {min(digits[-1], 20)}")
    if len(d) >= 12:
        out += [f"lead {d[0]}", "check digit" if luhn(d) else "no check digit"]
    if digits and "." in w and all(len(x) <= 3 and int(x) <= 255 for x in re.findall("[0-9]+", w)):
        out.append("bytes")
    return out


class Features:
    """Numbers of the features of a training table, at every reach."""

    def __init__(self, sentences: list[list[str]]):
        names = sorted({f for words in sentences for w in words for f in word_features(w)})
        self.number = {f: k for k, f in enumerate(names)}
        self.size = len(names)

    def of(self, word: str) -> list[int]:
        return [self.number[f] for f in word_features(word) if f in self.number]

    def rows(self, words: list[str]) -> np.ndarray:
        """0/1 matrix of the words' own features and those of the words around them, and a bias."""
        x = np.zeros((len(words), len(REACH) * self.size + 1))
        x[:, -1] = 1
        for j, w in enumerate(words):
            for r, step in enumerate(REACH):
                if 0 <= j + step < len(words):
                    x[j + step, [r * self.size + k for k in self.of(w)]] = 1
        return x


class Field:
    """The trained chain with its features.

    A word without digits and at signs is outside whatever its neighbours are, so lines without any need no decoding.
    """

    def __init__(self, table: list[tuple[list[str], list[str]]], steps: int = 120):
        self.features = Features([w for w, _ in table])
        data = [(self.features.rows(w), np.array([LABELS.index(x) for x in y])) for w, y in table]
        self.chain = Chain.train(data, len(LABELS), steps, decay=2e-4)
        size = self.features.size
        self.emit = self.chain.emit[:-1].reshape(len(REACH), size, len(LABELS))
        self.bias = self.chain.emit[-1]

    def scores(self, word: str) -> np.ndarray:
        """What a word says about itself and the words around it: REACH x labels."""
        own = self.features.of(word)
        out = self.emit[:, own].sum(1)
        out[0] += self.bias
        if not _MARKED.search(word):
            out[0, 1:] -= 1e6
        return out

    def decode(self, lines: list[list[np.ndarray]]) -> list[np.ndarray]:
        """Labels of lines of word scores, all lines side by side."""
        scores = []
        for line in lines:
            rows = np.stack(line)
            e = rows[:, 0].copy()
            for r, step in enumerate(REACH[1:], 1):
                if abs(step) < len(e):
                    if step > 0:
                        e[step:] += rows[:-step, r]
                    else:
                        e[:step] += rows[-step:, r]
            scores.append(e)
        return self.chain.decode(scores)

    def label(self, sentences: list[list[str]]) -> list[list[str]]:
        return [[LABELS[k] for k in y] for y in self.decode([[self.scores(w) for w in words] for words in sentences])]


@lru_cache(maxsize=1)
def field() -> Field:
    """The field of the training table (deterministic; a few seconds)."""
    return Field(training_table())


class _Scores(dict):
    """Word -> its scores, remembered up to a bound."""

    def __init__(self, own: Field):
        super().__init__()
        self.own = own

    def __missing__(self, word: str) -> np.ndarray:
        row = self.own.scores(word)
        if len(self) > 50_000:
            self.clear()
        if len(word) <= 64:
            self[word] = row
        return row


def _lines(text: str) -> list[tuple[int, str]]:
    """Lines with a digit or an at sign."""
    out, at = [], 0
    while m := _TRIGGER.search(text, at):
        a = text.rfind("\n", 0, m.start()) + 1
        b = text.find("\n", m.start())
        b = len(text) if b < 0 else b
        out.append((a, text[a:b]))
        at = b
    return out


def find_spans(texts: list[str], own: Field) -> list[list[tuple[str, int, int, bool]]]:
    """Per text its spans (kind, start, end, base) in code points, by kind, then start.

    Spans of the field are added where they overlap no base span.
    """
    out: list[list[tuple[str, int, int, bool]]] = []
    cache = _Scores(own)
    pending: list[tuple[int, int, list[re.Match]]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        lines = [[cache[w.group()] for w in words] for _, _, words in pending]
        for (doc, at, words), labels in zip(pending, own.decode(lines)):
            if labels.any():
                out[doc] += _runs(at, words, labels, out[doc])
        pending.clear()
        held = 0

    for doc, text in enumerate(texts):
        base: list[tuple[str, int, int, bool]] = []
        out.append(base)
        for at, line in _lines(text):
            base += [(kind, at + a, at + b, True) for kind, find in _BASE for a, b in find(line)]
            words = list(_WORD.finditer(line))
            pending.append((doc, at, words))
            held += len(words)
        if held > AT_ONCE:
            flush()
    flush()
    for spans in out:
        spans.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
    return out


def _runs(at: int, words: list[re.Match], labels: np.ndarray, base: list) -> list[tuple[str, int, int, bool]]:
    """Runs of words of one label as spans, without quotes and closing marks, where no base span lies."""
    spans, i = [], 0
    while i < len(words):
        j = i + 1
        if labels[i]:
            while j < len(words) and labels[j] == labels[i]:
                j += 1
            first, last = words[i].group(), words[j - 1].group()
            a = words[i].start() + len(first) - len(first.lstrip(_STRIP_LEFT))
            b = words[j - 1].end() - (len(last) - len(last.rstrip(_STRIP_RIGHT)))
            if a < b and not any(x[1] < at + b and at + a < x[2] for x in base if x[3]):
                spans.append((LABELS[labels[i]], at + a, at + b, False))
        i = j
    return spans


SPANS = "array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"
_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def _found(batches: Iterator[pa.Array], own: Field) -> Iterator[tuple[list[str | None], list[list[dict]]]]:
    """Texts and their spans, in slices that bound a task's memory."""
    for texts in batches:
        for a, b in slices(texts, BYTES_AT_ONCE):
            part = texts.slice(a, b - a).to_pylist()
            spans = find_spans([t or "" for t in part], own)
            yield part, [[dict(zip(("kind", "start", "end", "base"), s)) for s in found] for found in spans]
            release()


def spans_column(text: Column) -> Column:
    """Spans of personal data (code points, end exclusive) of a text column; null and empty texts have none."""
    own = field()

    @F.arrow_udf(SPANS)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for _, spans in _found(batches, own):
            yield pa.array(spans, _TYPE)

    return find(text)


def redacted_column(text: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, null stays null."""
    own = field()

    @F.arrow_udf("string")
    def redact(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts, spans in _found(batches, own):
            yield pa.array([redacted(t, s) for t, s in zip(texts, spans)], pa.string())

    return redact(text)


def redacted(text: str | None, spans: list[dict] | None) -> str | None:
    if not text or not spans:
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at:s["start"]], f"[{s['kind']}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, text_col: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with an array column of spans (kind, start, end, base).

    Null and empty texts have no spans; repeated rows get the same spans; an empty table stays empty; other columns pass
    through (one named as the new column is replaced).
    """
    ship(docs.sparkSession)
    return docs.withColumn(into, spans_column(F.col(text_col).cast("string")))


def redact_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the columns of ``docs``: personal data in ``text`` is replaced, ``n_chars`` follows it."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    rows = rows.withColumn("clean", redacted_column(F.col("text")))
    new = {"text": F.col("clean"), "n_chars": F.char_length("clean").cast("long")}
    return rows.select(*[new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])


def _listed(base_only: bool) -> Column:
    spans = F.filter("pii", lambda s: s["base"]) if base_only else F.col("pii")
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def op8_pii(spark, sf_dir):
    """Registered query: personal data in the whole ``documents`` table."""
    out = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [_count(kind).alias(f"n_{kind}") for kind in KINDS[:4]]
    return out.select("doc_id", *counts, F.sha2(_listed(True), 256).alias("base_sha256"), _listed(False).alias("spans"))
