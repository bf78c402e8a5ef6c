"""Token counts by a linear longest-match automaton.

The vocabulary is a trie. Every node that greedy matching can get stuck at has a failure link to the node it goes on from, and
the number of pieces that are complete by then. One pass over a word's characters adds up these numbers: the length of its
greedy longest-match segmentation, without building a piece and without going back over a character. A character where no piece
starts counts as the byte pieces of its UTF-8 form, and matching goes on behind it.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, strings, table

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
#: The character that starts a word in the vocabulary.
START = "▁"
REMEMBERED = 600_000
#: Added to a length for each uncovered character; lengths stay below it.
UNCOVERED = 1 << 32


class LongestMatch:
    """Greedy longest-match lengths over a set of pieces."""

    def __init__(self, pieces: list[str]):
        self.next: list[dict[str, int]] = [{}]
        weight = [0]                            # of the piece that ends at a node

        def add(piece: str, value: int) -> None:
            at = 0
            for c in piece:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    weight.append(0)
                    self.next.append({})
                at = self.next[at][c]
            weight[at] = weight[at] or value

        for p in pieces:
            if p:
                add(p, 1)
        for c in {c for p in pieces for c in p}:
            add(c, covered_by_bytes(c))         # taken only where no piece starts
        # from any node the characters so far come to pieces and the text of another node
        self.fail = [0] * len(self.next)
        self.popped = [0] * len(self.next)      # weight of the pieces complete on the way along the failure link
        level = [0]
        while level:
            deeper = []
            for u in level:
                for c, v in self.next[u].items():
                    deeper.append(v)
                    if weight[v]:
                        self.popped[v] = weight[v]
                        continue
                    at, done = self.fail[u], self.popped[u]
                    while c not in self.next[at]:           # the root has all characters
                        done += self.popped[at]
                        at = self.fail[at]
                    self.fail[v], self.popped[v] = self.next[at][c], done
            level = deeper

    def length(self, word: str) -> int:
        """Pieces of the word's greedy segmentation, and UNCOVERED for each character that no piece covers."""
        at, n = 0, 0
        for c in word:
            while (to := self.next[at].get(c)) is None and at:
                n += self.popped[at]
                at = self.fail[at]
            if to is None:                      # a character of no piece
                n += covered_by_bytes(c)
            else:
                at = to
        while at:
            n += self.popped[at]
            at = self.fail[at]
        return n


def covered_by_bytes(c: str) -> int:
    return len(c.encode("utf-8", "surrogatepass")) + UNCOVERED


def vocabulary_pieces(path: str = VOCABULARY) -> list[str]:
    """Normal pieces of a sentencepiece model (no control or byte pieces)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(k) for k in range(model.vocab_size())
            if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]


class Counter:
    """Lengths of words, remembered up to a bound."""

    def __init__(self, path: str):
        self.automaton, self.known = LongestMatch(vocabulary_pieces(path)), {}

    def lengths(self, words: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(found == -1).tolist()
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
        for k in new:
            w = words[k]
            found[k] = self.automaton.length(START + w) if w else 0
            if len(w) <= 64:
                self.known[w] = int(found[k])
        return found

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, tokens, words with an uncovered character) of each text."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten().dictionary_encode()
        distinct = strings(words.dictionary)
        of = self.lengths(distinct)
        real = np.array([w != "" for w in distinct], bool)
        which, ends = words.indices.to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(values[which])])[ends])

        return per_text(real.astype(np.int64)), per_text(of % UNCOVERED), per_text((of >= UNCOVERED).astype(np.int64))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(text: Column, path: str = VOCABULARY) -> Column:
    """Struct (n_words, n_tokens, n_unknown) of a text column."""
    @F.arrow_udf("struct<n_words: bigint, n_tokens: bigint, n_unknown: bigint>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(x) for x in counter(path).count(texts)],
                                          ["n_words", "n_tokens", "n_unknown"])

    return of(text)


def count_tokens(docs: DataFrame, text_col: str = "text", into: str = "tokens", path: str = VOCABULARY) -> DataFrame:
    """``docs`` with a struct column of counts.

    Words are runs between ASCII white space; unspaced text is one word. A character where no piece of the vocabulary starts counts as
    its UTF-8 bytes (one byte piece each), and its word as unknown (n_unknown).
    Null, empty and blank texts have no words; repeated rows count alike; an empty table stays empty; other columns pass
    through (one named as the new column is replaced).
    """
    ship(docs.sparkSession)
    return docs.withColumn(into, token_counts(F.col(text_col).cast("string"), path))


def op10_token_counts(spark, sf_dir):
    """Registered query: token counts of the whole ``documents`` table."""
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "tokens.*")
