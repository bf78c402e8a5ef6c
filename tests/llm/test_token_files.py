import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from keyrelay.llm import token_files as t


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(t.VOCABULARY)


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 8, 9, 1000, t.BLOCK, t.BLOCK + 1, 3 * t.BLOCK):
        for top in (1, 2, 255, 256, 49408, 1 << 20, (1 << 32) - 1):
            ids = rng.integers(0, top, n, dtype=np.uint32)
            index, payload = t.pack(ids, bits)
            assert np.array_equal(t.unpack(index, payload, n, bits), ids)
            assert sum(map(sum, index)) == len(payload)
            assert all(len(p) <= (32 if bits else 4) for p in index)


@pytest.mark.parametrize("remembered", [1_000_000, 40])
def test_encoder_against_the_library(library, real, monkeypatch, remembered):
    monkeypatch.setattr(t, "REMEMBERED", remembered)
    rng = random.Random(1)
    marks = "\x01 \n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u2003\u3000\u200b\u0301\u0308eE'sStdml09é中ßİΣσ.,!"
    texts = [x for _, x in real] + ["".join(rng.choice(marks) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += [x + "<|endoftext|>" + x for x in texts[-300:]]
    coder = t.Encoder(t.VOCABULARY)
    for at in range(0, len(texts), 300):
        part = texts[at:at + 300]
        counts, ids = coder.encode(pa.array([None, *part])[1:])
        want = [library.encode(x or "", add_special_tokens=False).ids for x in part]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


@pytest.mark.parametrize("bits,chunk", [(False, 1 << 18), (True, 500)])
def test_files_round_trip(spark, docs_of, real, library, monkeypatch, tmp_path, bits, chunk):
    monkeypatch.setattr(t, "CHUNK", chunk)
    path = t.write_token_files(docs_of(real, extra=True), str(tmp_path / "files"), bits=bits, shards=5)
    rows = sorted(t.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert len(rows) == len(real)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    texts, at = {}, 0
    for i, x in real:
        texts.setdefault(i, []).append(library.encode(x or "", add_special_tokens=False).ids + [2])
    for r in rows:
        got = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(got)
        texts[r.doc_id].remove(got)
        at += len(got)
    assert not any(texts.values())


def test_empty_table(spark, docs_of, tmp_path):
    assert t.read_token_files(spark, t.write_token_files(docs_of([]), str(tmp_path / "none"))).collect() == []


def test_registered_query(spark, library):
    from keyrelay.llm.queries import queries
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    at = 0
    for r in sorted(queries()["op4_token_files"](spark, sf).collect(), key=lambda r: r.doc_id):
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_long_words_are_not_remembered(library):
    coder = t.Encoder(t.VOCABULARY)
    texts = [f"short words {k} " + "longword\t" * 500 + f"{k}" for k in range(50)]
    for text in texts:
        assert coder.encode(pa.array([text]))[1].tolist() == library.encode(text, add_special_tokens=False).ids
    assert max(map(len, coder.known.rows)) <= 64 and len(coder.known.start) == len(coder.known.rows)
    assert coder.known.held < 10**5 and int(coder.known.size.sum()) == len(coder.known.flat)


def test_words_are_encoded_by_their_parts(library):
    """Letters in any case and with any marks around them are encoded once, and as the whole word is (F1)."""
    rng, coder = random.Random(7), t.Encoder(t.VOCABULARY)
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    letters = [chr(c) for c in range(65, 256) if chr(c).isalpha()]
    cores = ["".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(400)] + letters + ["the", "don", "l", "s", "t", "w"]
    words = [f(w) for w in cores for f in (str, str.lower, str.upper, str.title)]
    words = ["".join(rng.choices(marks, k=rng.randint(0, 3))) + w + "".join(rng.choices(marks, k=rng.randint(0, 4))) for w in words for _ in "123"]
    words += [m + "the" + m for m in marks] + ["don't", "it's", "'s", "</w>", "the</w>", "a<|endoftext|>", "<|endoftext|>b", "Éa", "á", "ª", "µm"]
    for texts in (words, [" ".join(rng.choices(words, k=30)) for _ in range(300)]):
        counts, ids = coder.encode(pa.array(texts))
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    other = t.Encoder(t.VOCABULARY)
    other.encode(pa.array(["The the THE! (the) the... \"The\" THE, they"]))
    assert {w for w in other.known.rows if "the" in w.lower()} == {"the", "they"}
