"""Language identification by a convolutional network over bytes.

Filters of several widths run over a text's bytes; each one's largest value in a window (max pooling) feeds a softmax over the
languages. A filter has one weight per byte value and place, so a convolution is a sum of table rows. The network is trained in
numpy on windows of a bounded sample of labelled documents, then applied to all windows of every text in batches; a text's
probabilities are the mean of its windows', weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import expand, release, ship, slices, table, utf8


@dataclass(frozen=True)
class Network:
    """Shape of the network and bounds of its training (all documented parameters)."""

    window: int = 128           # bytes that are pooled together
    widths: tuple = (2, 3, 4)   # bytes a filter sees
    filters: int = 16           # of each width
    per_language: int = 500     # labelled documents learned from, for each language
    windows: int = 6            # windows learned from, in each of these documents
    languages: int = 400        # languages learned, the most frequent ones
    epochs: int = 6
    batch: int = 128
    rate: float = 0.01
    seed: int = 11


class Model:
    """``places[j]``: 256 x filters, what a byte at place j adds to each filter; then bias, softmax weights and bias."""

    def __init__(self, labels: list[str], net: Network):
        self.labels, self.net = labels, net
        rng, wide = np.random.default_rng(net.seed), max(net.widths)
        self.places = [np.zeros((256, net.filters * len(net.widths)), np.float32) for _ in range(wide)]
        for k, w in enumerate(net.widths):
            for j in range(w):
                self.places[j][:, k * net.filters:(k + 1) * net.filters] = rng.normal(0, w ** -0.5, (256, net.filters))
        # a place beyond a filter's width stays zero
        self.mask = [np.repeat(np.array([j < w for w in net.widths], np.float32), net.filters) for j in range(wide)]
        n = net.filters * len(net.widths)
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, n ** -0.5, (n, len(labels))).astype(np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)

    def pooled(self, windows: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """(largest value of each filter, and its place if asked for) of windows of ``window`` + wide - 1 bytes each."""
        columns = np.ascontiguousarray(windows.T)
        best = np.full((len(windows), len(self.bias)), -np.inf, np.float32)
        at = np.zeros(best.shape, np.int32) if where else None
        value, part = np.empty_like(best), np.empty_like(best)
        for p in range(self.net.window):
            np.take(self.places[0], columns[p], axis=0, out=value, mode="clip")
            for j in range(1, len(self.places)):
                np.take(self.places[j], columns[p + j], axis=0, out=part, mode="clip")
                value += part
            if where:
                at[value > best] = p
            np.maximum(best, value, out=best)
        return best, at

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.pooled(windows)[0] + self.bias, 0)
        return softmax(hidden @ self.out + self.out_bias)

    def train(self, windows: np.ndarray, targets: np.ndarray) -> None:
        """Adam on the cross entropy; through the pooling, only a filter's best place learns."""
        net, rng = self.net, np.random.default_rng(self.net.seed + 1)
        weights = [*self.places, self.bias, self.out, self.out_bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        columns, step = np.arange(len(self.bias)), 0
        for _ in range(net.epochs):
            order = rng.permutation(len(windows))
            for a in range(0, len(order), net.batch):
                rows = order[a:a + net.batch]
                x, y, n = windows[rows], targets[rows], len(rows)
                best, at = self.pooled(x, where=True)
                hidden = np.maximum(best + self.bias, 0)
                error = softmax(hidden @ self.out + self.out_bias)
                error[np.arange(n), y] -= 1
                error /= n
                back = (error @ self.out.T) * (hidden > 0)
                grads = []
                for j, mask in enumerate(self.mask):
                    g = np.zeros_like(self.places[j])
                    np.add.at(g, (np.take_along_axis(x, at + j, 1), columns), back * mask)
                    grads.append(g)
                grads += [back.sum(0), hidden.T @ error, error.sum(0)]
                step += 1
                for w, g, m, v in zip(weights, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= net.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


#: Windows taken at once, bytes of text at once.
SIDE, AT_ONCE = 512, 1 << 20


def predict(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(label number, probability) of texts; -1 and 0 for the empty text.

    Windows follow each other without gaps and are padded with zero bytes at a text's end. The last bytes a filter needs beyond its
    window are those of the next one, so no place of a text is left out.
    """
    net, label, score = model.net, np.full(len(texts), -1), np.zeros(len(texts))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if not sizes.sum():
        return label, score
    raw, column = np.frombuffer(b"".join(texts), np.uint8), np.arange(net.window + max(net.widths) - 1)
    owner, number = expand(-(-sizes // net.window))
    left = sizes[owner] - number * net.window               # bytes from a window's start to its text's end
    start = (np.cumsum(sizes) - sizes)[owner] + number * net.window
    weight = np.minimum(left, net.window)[:, None]
    total = np.zeros((len(texts), len(model.labels)))
    for a in range(0, len(owner), SIDE):
        own = slice(a, a + SIDE)
        at = start[own, None] + column
        windows = np.where(column < left[own, None], raw[np.minimum(at, len(raw) - 1)], 0).astype(np.uint8)
        np.add.at(total, owner[own], model.probabilities(windows) * weight[own])
    has = sizes > 0
    mean = total[has] / total[has].sum(1, keepdims=True)
    label[has], score[has] = mean.argmax(1), mean.max(1)
    return label, score


def learned(doc_id: Column) -> Column:
    """Whether a document may be learned from: it has an id and is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, net: Network) -> list[tuple[str, bytes]]:
    """(language, window) of the bounded sample, in a fixed order.

    Languages are counted first; then a share of each one's documents, a little more than is asked for, is drawn by a hash of
    the text, and of these the first by hash are taken, equal texts once. So few rows meet in one place, however large a language is.
    Windows are spread evenly over the whole text.
    """
    spark = docs.sparkSession
    usable = docs.filter(learned(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(LETTER))
    counts = (usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
              .limit(net.languages).collect())
    if not counts:
        return []
    rows = [(r["lang"], min(1.0, (2 * net.per_language + 200) / r["n"])) for r in counts]
    shares = F.broadcast(spark.createDataFrame(rows, "lang string, share double"))      # at most ``languages`` rows
    # a hash of text and id draws, so that one text in very many rows is not drawn whole or not at all
    draw = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = usable.join(shares, "lang").filter(draw < F.col("share"))
    one = drawn.select("lang", "text", F.xxhash64("text").alias("h"))
    top = one.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text")))
    top = top.filter(F.col("place") <= net.per_language)
    raw, reach = F.col("text").cast("binary"), net.window + max(net.widths) - 1
    size = F.octet_length("text")
    step = F.greatest((size - net.window) / max(1, net.windows - 1), F.lit(float(net.window)))
    starts = F.transform(F.sequence(F.lit(0), F.lit(net.windows - 1)), lambda k: F.floor(k * step).cast("int"))
    parts = top.select("lang", "place", F.posexplode(starts).alias("k", "start"), raw.alias("raw"))
    parts = parts.filter(F.col("start") < F.octet_length("raw")).select(
        "lang", "place", "k", F.substring(F.col("raw"), F.col("start") + 1, F.lit(reach)).alias("w"))
    found = parts.collect()                                 # languages * per_language * windows windows at most
    return [(r["lang"], bytes(r["w"])) for r in sorted(found, key=lambda r: (r["lang"], r["place"], r["k"]))]


def fit(docs: DataFrame, net: Network = Network()) -> Model | None:
    """A model of the sampled windows; None where nothing can be learned from."""
    found = sample(docs, net)
    if not found:
        return None
    labels = sorted({lang for lang, _ in found})
    place = {lang: k for k, lang in enumerate(labels)}
    reach = net.window + max(net.widths) - 1
    windows = np.frombuffer(b"".join(w.ljust(reach, b"\0") for _, w in found), np.uint8).reshape(-1, reach)
    model = Model(labels, net)
    model.train(windows, np.array([place[lang] for lang, _ in found]))
    return model


#: Text that has a language; the prediction for other text.
LETTER, NONE = r"\p{L}", "und"
RESULT = "struct<lang_pred: string, score: double>"


def predict_column(text: Column, model: Model) -> Column:
    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = pa.array(model.labels, pa.string())
        for column in batches:
            for a, b in slices(column, AT_ONCE):
                label, score = predict(model, [t or b"" for t in utf8(column.slice(a, b - a))])
                own = names.take(pa.array(label, mask=label < 0))
                yield pa.StructArray.from_arrays([own, pa.array(score)], ["lang_pred", "score"])
                release()

    return run(text)


def identify(docs: DataFrame, model: Model | None, into: str = "language") -> DataFrame:
    """``docs`` with a struct column (lang_pred, score): the likeliest learned language of the whole text and its probability.

    A text that is null, empty or without a letter is ``und`` with score 0, and so is every text where nothing could be learned.
    Predictions depend on the text alone, so repeated texts come out alike; an empty table stays empty; other columns pass
    through (one named as the new column is replaced). A task holds a slice of texts, the longest one at least.
    """
    ship(docs.sparkSession)
    none = F.struct(F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"))
    if model is None:
        return docs.withColumn(into, none)
    text = F.col("text").cast("string")
    letters = F.coalesce(text.rlike(LETTER), F.lit(False))
    coded = docs.withColumn(into, predict_column(F.when(letters, text), model))
    return coded.withColumn(into, F.struct(F.coalesce(F.col(f"{into}.lang_pred"), F.lit(NONE)).alias("lang_pred"),
                                           F.col(f"{into}.score").alias("score")))


def op11_language(spark, sf_dir):
    """Registered query: the language of every text of ``documents``, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = identify(docs.select("doc_id", "text"), fit(docs.select("doc_id", "text", "lang")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score")
