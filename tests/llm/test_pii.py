import random
import re

import numpy as np
from pyspark.sql import functions as F

from keyrelay.llm import pii
from keyrelay.llm.crf import Chain
from keyrelay.llm.pii_examples import FILL, HELD_FILL, held_out_table, training_table

PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(pii._digits(m)) <= 19 and pii.luhn(pii._digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(pii._digits(m)) <= 15)}


def plain(text):
    return [(k, m.start(), m.end(), True) for k, (p, ok) in PLAIN.items() for m in re.finditer(p, text or "") if ok(m.group())]


def test_base_spans_against_the_patterns(real):
    rng = random.Random(3)
    texts = [t or "" for _, t in real] + ["".join(rng.choice("ab1.@+-_% ()\n4029é,") for _ in range(rng.randint(1, 80)))
                                         for _ in range(4000)]
    texts += ["".join(rng.choice(["4111111111111111", "1.2.3.4", "256.", "a@b.c", "@d.e", "+1 (523) 555-1055", " ", "-", "\n", "7"])
                      for _ in range(12)) for _ in range(2000)]
    for text, spans in zip(texts, pii.find_spans(texts, pii.field())):
        assert [s for s in spans if s[3]] == plain(text), text


def test_field_finds_what_the_patterns_miss():
    chain = pii.field()
    texts = ["Please call (415) 555-0134 now.", "Her ssn is 987-65-4320.", "phone: 415-555-0199, thanks", "no data here 12 34",
             "los 555-9331 4913187196670932 53.121.55.90", "version 4.5.6 of 2023-11-05 sold 1200 at 3.50", "at at at at dot 5 at at"]
    got = [[(k, t[a:b]) for k, a, b, base in s if not base] for t, s in zip(texts, pii.find_spans(texts, chain))]
    assert got[0] == [("phone", "(415) 555-0134")]
    assert got[1] == [("ssn", "987-65-4320")]
    assert got[2] == [("phone", "415-555-0199")]
    assert ("card", "4913187196670932") in got[4]
    assert got[3] == got[5] == got[6] == []


def measured(table):
    """(precision, recall) of the field over words, and the kinds of phones and numbers that the patterns do not know."""
    found = pii.field().label([w for w, _ in table])
    pairs = [(a, b) for (_, y), got in zip(table, found) for a, b in zip(y, got)]
    right = sum(a == b != "outside" for a, b in pairs)
    return right / sum(b != "outside" for _, b in pairs), right / sum(a != "outside" for a, _ in pairs)


def test_held_out_precision_and_recall():
    """Other sentences with other fillings: none of either is in the training table."""
    held, trained = held_out_table(), training_table()
    assert not {" ".join(w) for w, _ in held} & {" ".join(w) for w, _ in trained}
    for slot, texts in HELD_FILL.items():
        assert not set(texts) & set(FILL[slot])
    precision, recall = measured(held)
    assert len(held) > 90 and precision >= 0.95 and recall >= 0.9
    # of the kinds that the patterns do not find, recall alone
    own = [(w, y) for w, y in held if set(y) & {"phone", "ssn"}]
    assert measured(own)[1] >= 0.95


def test_numbers_of_other_kinds_are_left_alone():
    texts = ["part no. 219-09-9999", "version 123-45-6789", "score 212-555-0180", "Licensed under CC BY-NC 4.0.", "phone 4155552671",
             "Call 020 7946 0958", "order no. 987-65-4320", "!! 5927243074273350!! of"]
    got = [[(k, t[a:b]) for k, a, b, base in s if not base] for t, s in zip(texts, pii.find_spans(texts, pii.field()))]
    assert got == [[], [], [], [], [("phone", "4155552671")], [("phone", "020 7946 0958")], [], []]


def test_viterbi_against_brute_force():
    rng = np.random.default_rng(2)
    chain = Chain(np.zeros((1, 3)), rng.normal(size=(3, 3)))
    scores = [rng.normal(size=(n, 3)) for n in (1, 4, 6, 3, 6, 2)]
    from itertools import product
    for e, got in zip(scores, chain.decode(scores)):
        def value(path, e=e):
            return sum(e[k, y] for k, y in enumerate(path)) + sum(chain.move[a, b] for a, b in zip(path, path[1:]))
        assert tuple(got) == max(product(range(3), repeat=len(e)), key=value)


def test_words_without_digits_are_outside():
    """Whatever their neighbours are; so lines without digits and at signs need no decoding."""
    lines = ["call the phone and mail the card to the host social security ssn ip at dot com", "ssn phone card 123-45-6789 phone 4155552671 visa"]
    for words, labels in zip(map(str.split, lines), pii.field().label([x.split() for x in lines])):
        assert all(y == "outside" for w, y in zip(words, labels) if not re.search("[0-9@]", w))


def test_redacted_documents(docs_of, real):
    docs = docs_of(real, extra=True)
    out = pii.redact_documents(docs)
    assert out.columns == docs.columns and out.count() == len(real)
    left = pii.find_pii(out).filter(F.exists("pii", lambda s: s["base"])).count()
    assert left == 0
    assert out.filter(F.col("n_chars") != F.char_length("text")).count() == 0
    assert pii.redacted("ab12cd", [{"start": 2, "end": 4, "kind": "card", "base": True}]) == "ab[card]cd"
    assert pii.redacted("abcdef", [{"start": 1, "end": 4, "kind": "a"}, {"start": 2, "end": 5, "kind": "b"}]) == "a[a]f"
    assert pii.find_pii(docs_of([])).collect() == []


def test_long_runs_of_zeros_in_dotted_numbers():
    zeros = "0" * 5000
    texts = [zeros + ".1.1.1", f"1.{zeros}7.2.3 is the host", f"9.9.9.{zeros}256", f"{zeros}.{zeros}.{zeros}.{zeros}"]
    got = [[s for s in spans if s[0] == "ip" and s[3]] for spans in pii.find_spans(texts, pii.field())]
    assert got == [[("ip", 0, 5006, True)], [("ip", 0, 5007, True)], [], [("ip", 0, 20003, True)]]
