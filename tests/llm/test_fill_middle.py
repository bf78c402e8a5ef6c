"""Fill-in-middle: units, cuts and forms against plain regular expressions, chunks that are shared, exact restoring."""

import hashlib
import random
import re

import numpy as np

from keyrelay.llm import fill_middle as fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    """The contract, step by step: (n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    units = UNIT.findall(text)
    n, d = len(units), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[8 * k:8 * k + 8], 16) for k in range(4))
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, form, len(prefix), len(middle), out


def test_documents(docs_of, real):
    marked = [(2000 + k, t) for k in range(40) for t in ("a <P> b", "x<", "<S", "ends in space \n", " \t ", "a<<S b <M", "é ß" * 500)]
    rows = real + marked
    df = fim.fill_middle(docs_of(rows, extra=True))
    out = df.select("doc_id", "text", "fim.*", fim.restored(df.fim.output, df.fim.form).alias("back")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert fim.fill_middle(docs_of([])).collect() == []


def test_every_cut_of_odd_texts():
    rng = random.Random(3)
    marks = [" ", "\n", "\x0b", "\x1c", "\xa0", "a", "é", "中", "𝄞", "word", "\x00"]
    for _ in range(60):
        text = "".join(rng.choices(marks, k=rng.randint(0, 4000)))
        raw = text.encode()
        ends = fim.borders(np.frombuffer(raw, np.uint8), [0, len(raw)])[0]
        chunks = [raw[a:b] for a, b in zip([0, *ends], ends)]
        cutter = fim.Cutter(chunks, fim.Summaries().of(chunks))
        units = UNIT.findall(text)
        assert cutter.n == len(units)
        for k in {0, len(units), *(rng.randint(0, len(units)) for _ in range(30))}:
            before = "".join(units[:k])
            assert cutter.after(k) == (len(before.encode()), len(before))


def test_chunks_follow_the_content():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(400)]
    passage = " ".join(rng.choices(words, k=4000))
    known, found = fim.Summaries(), []
    for k in range(5):
        text = (" ".join(rng.choices(words, k=50 + k)) + passage + "x" * k).encode()
        ends = fim.borders(np.frombuffer(text, np.uint8), [0, len(text)])[0]
        sizes = np.diff([0, *ends])
        assert ends[-1] == len(text) and sizes.max() <= fim.MOST and (sizes[:-1] >= fim.LEAST).all()
        before = known.found
        known.of([text[a:b] for a, b in zip([0, *ends], ends)])
        found.append((known.found - before) / len(ends))
    assert found[0] == 0 and min(found[1:]) > 0.7       # the shared passage is cut alike wherever it stands


def test_texts_without_borders():
    for text in (b"a" * 100_000, "é".encode() * 50_000, b" " * 30_000):
        ends = fim.borders(np.frombuffer(text, np.uint8), [0, len(text)])[0]
        assert ends[-1] == len(text) and max(np.diff([0, *ends])) <= fim.MOST
        for a, b in zip([0, *ends], ends):
            text[a:b].decode()


def test_what_is_remembered_is_bounded():
    known = fim.Summaries(held=40_000)
    for k in range(300):
        known.of([b"%d " % k * 200, b"same words again " * 20])
    assert sum(map(len, known.young)) + sum(map(len, known.old)) <= 60_000
