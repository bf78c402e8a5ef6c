import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from keyrelay.llm import bpe


@pytest.fixture(scope="module")
def library():
    ranks = bpe.codec().ranks.ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_against_the_library(docs_of, real, library):
    rows = bpe.encode_documents(docs_of(real, extra=True)).select("text", "coded.*").collect()
    assert len(rows) == len(real)
    for r in rows:
        assert r.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode_documents(docs_of([])).collect() == []


def test_long_pieces_without_spaces(library):
    rng = random.Random(2)
    for text in ("a" * 5000, "ab" * 3000, "".join(rng.choice("abcdeionts") for _ in range(8000)),
                 "".join(rng.choice("éèüñ中文字日本語кот") for _ in range(3000)), "=" * 4097, " " * 3000 + "x"):
        assert bpe.encode_text(text) == library.encode_ordinary(text)


def test_white_space_of_all_kinds(library):
    rng = random.Random(8)
    marks = [" ", "  ", "   ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "a", "é", "1", "'s", ",", "the", "\u0301"]
    texts = ["".join(rng.choices(marks, k=rng.randint(0, 12))) for _ in range(6000)]
    n, flat = bpe.codec().encode(pa.array([*texts, None]))
    assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [library.encode_ordinary(t) for t in texts] + [[]]


def test_join_is_the_encoding_of_the_whole(library):
    ranks, rng = bpe.codec().ranks, random.Random(6)
    tokens = [t for t in ranks.ranks if len(t) > 1]
    for _ in range(2000):
        left, right = (b"".join(rng.choices(tokens, k=rng.randint(1, 6))) for _ in "lr")
        assert ranks.join(ranks.tree(left), ranks.tree(right)) == ranks.merge(left + right) == ranks.merge_long(left + right)


SPACED = ["def f(x):\n    if x:  # {0}\n        return  {0} \n\n" * 40, "Two spaces.  After each {0} end.  " * 60, "a{0}" * 900, "{0}  b", "  {0}"]


def test_texts_with_spaces_beside_white_space_are_not_remembered(docs_of, library):
    texts = [t.replace("{0}", f"name{k}") for k in range(60) for t in SPACED]
    own = bpe.Codec(bpe.VOCABULARY, public_tokenizers.PATTERN)
    for at in range(0, len(texts), 50):
        part = texts[at:at + 50]
        n, flat = own.encode(pa.array(part))
        assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [library.encode_ordinary(t) for t in part]
    for kept in (own.known, own.pieces):
        assert max(map(len, kept.rows)) <= 64 and len(kept.start) == len(kept.size) == len(kept.rows)
        assert kept.held < 10**6 and int(kept.size.sum()) == len(kept.flat)
    rows = bpe.encode_documents(docs_of(list(enumerate(texts)))).select("text", "coded.*").collect()
    assert all(r.ids == library.encode_ordinary(r.text) and bytes(r.decoded) == r.text.encode() for r in rows)


def test_what_is_remembered_is_bounded_in_bytes(library, monkeypatch):
    monkeypatch.setattr(bpe.Remembered, "HELD", 20_000)
    own, rng = bpe.Codec(bpe.VOCABULARY, public_tokenizers.PATTERN), random.Random(3)
    for _ in range(60):
        text = " ".join("".join(rng.choices("abcdeéñ中", k=rng.randint(1, 90))) for _ in range(30))
        assert own.encode(pa.array([text]))[1].tolist() == library.encode_ordinary(text)
        assert own.known.held < 10_000 + 30 * 400


def test_ordinary_words_go_through_the_tree(spark, library, monkeypatch):
    """Of the pieces of the sample that are no token, over nine tenths are longer than a leaf and joined from halves."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    pieces = [p.encode() for r in rows for p in regex.findall(public_tokenizers.PATTERN, r.text)]
    ranks = bpe.codec().ranks
    other = [p for p in pieces if p not in ranks.ranks]
    assert len(other) > 10_000 and sum(len(p) > bpe.LEAF for p in other) > 0.9 * len(other)
    joined = []
    fresh = bpe.Ranks()
    join = fresh.join
    monkeypatch.setattr(fresh, "join", lambda a, b: joined.append(1) or join(a, b))
    for p in dict.fromkeys(other[:3000]):
        before = len(joined)
        assert fresh.encode(p) == library.encode_ordinary(p.decode())
        assert len(joined) > before or len(p) <= bpe.SHARED         # shorter ones may be known as a part already
    assert len(joined) > 500


def test_decoding_up_the_tree():
    ranks, rng = bpe.codec().ranks, random.Random(5)
    for n in (0, 1, bpe.FAN, bpe.FAN + 1, bpe.FAN ** 2, bpe.FAN ** 2 + 7, 20_000):
        ids = [rng.randrange(50_000) for _ in range(n)]
        assert ranks.decode(ids) == b"".join(ranks.token[i] for i in ids)


def test_trees_are_reduced_side_by_side(library, monkeypatch):
    """Equal leaves, pairs and windows of many pieces are looked up once a level, and every piece above a leaf is joined (F2)."""
    rng, own = random.Random(9), bpe.Codec(bpe.VOCABULARY, public_tokenizers.PATTERN)
    parts = ["th", "on", "en", "er", "ing", "tion", "é", "les", "ou", "an", "st", "中"]
    texts = [" ".join("".join(rng.choices(parts, k=rng.randint(2, 7))) for _ in range(400)) for _ in range(60)] + ["ab" * 3000, "=" * 999]
    calls, joined, ranks = [], [], own.ranks
    fits, window, joins = ranks.fits, ranks.window, ranks.joins
    monkeypatch.setattr(ranks, "fits", lambda a, b: calls.append(1) or fits(a, b))
    monkeypatch.setattr(ranks, "window", lambda piece: calls.append(1) or window(piece))
    monkeypatch.setattr(ranks, "joins", lambda data, flat, first, left: joined.append(len(left)) or joins(data, flat, first, left))
    n, flat = own.encode(pa.array(texts))
    assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [library.encode_ordinary(t) for t in texts]
    pieces = {p.encode() for t in texts for p in regex.findall(public_tokenizers.PATTERN, t)}
    other = [p for p in pieces if p not in ranks.ranks]
    assert sum(joined) >= sum(-(-len(p) // bpe.LEAF) - 1 for p in other) > 2 * len(other)
    assert 3 * len(calls) < sum(joined)


def test_many_pieces_at_once():
    ranks, rng = bpe.Ranks(), random.Random(4)
    tokens = list(ranks.ranks)
    pieces = [b"".join(rng.choices(tokens, k=rng.randint(1, 9))) for _ in range(3000)] + [b"a" * k for k in range(1, 200, 9)]
    size, flat = ranks.encode_many(pieces)
    assert [x.tolist() for x in np.split(flat, np.cumsum(size)[:-1])] == [ranks.encode(p) for p in pieces]
    assert [len(x) for x in ranks.encode_many([])] == [0, 0]
