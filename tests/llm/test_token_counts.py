import random

from keyrelay.llm import token_counts as t


def greedy(word, pieces, longest):
    at = n = 0
    while at < len(word):
        for end in range(min(len(word), at + longest), at, -1):
            if word[at:end] in pieces:
                break
        else:                       # no piece starts here: the bytes of one character
            at, n = at + 1, n + len(word[at].encode()) + t.UNCOVERED
            continue
        at, n = end, n + 1
    return n


def test_against_greedy_search():
    rng = random.Random(4)
    pieces = t.vocabulary_pieces()
    automaton, known, longest = t.LongestMatch(pieces), set(pieces), max(map(len, pieces))
    for _ in range(20000):
        word = t.START + "".join(rng.choice("abeinorst,éß中𝄞▁") for _ in range(rng.randint(0, 20)))
        assert automaton.length(word) == greedy(word, known, longest)
    for p in rng.sample(pieces, 3000):
        word = p + rng.choice(pieces)
        assert automaton.length(word) == greedy(word, known, longest)


def test_small_vocabularies():
    rng = random.Random(6)
    for _ in range(400):
        pieces = ["".join(rng.choices("ab", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 8))]
        automaton = t.LongestMatch(pieces)
        for _ in range(40):
            word = "".join(rng.choices("abc" if rng.random() < .2 else "ab", k=rng.randint(0, 12)))
            assert automaton.length(word) == greedy(word, set(pieces), 5), (pieces, word)


def test_documents(docs_of, real):
    pieces = set(t.vocabulary_pieces())
    longest = max(map(len, pieces))
    rows = t.count_tokens(docs_of(real, extra=True)).select("text", "tokens").collect()
    assert len(rows) == len(real)
    seen = {}
    for r in rows:
        words = (r.text or "").encode().split()
        of = [seen.setdefault(w, greedy(t.START + w.decode(), pieces, longest)) for w in words]
        assert tuple(r.tokens) == (len(words), sum(n % t.UNCOVERED for n in of), sum(n >= t.UNCOVERED for n in of))
    assert t.count_tokens(docs_of([])).collect() == []


def test_uncovered_characters_of_unspaced_text(docs_of):
    """A rare character in a long unspaced passage costs its bytes; the rest is counted as ever."""
    pieces = set(t.vocabulary_pieces())
    rare = next(c for c in "𠮷龘𪚥" if c not in pieces)
    passage = "".join(c for c in "的一是不了人我在有他这中大来上国" if c in pieces) * 12
    assert len(passage) > 100
    out = {r.doc_id: r.tokens for r in t.count_tokens(docs_of([(1, passage), (2, passage + rare), (3, rare + passage), (4, rare * 1000)])).collect()}
    assert tuple(out[1])[2] == 0 and tuple(out[2]) == (1, out[1].n_tokens + 4, 1)
    assert out[3].n_tokens >= out[1].n_tokens + 3 and out[3].n_unknown == 1
    assert tuple(out[4]) == (1, 4001, 1)
