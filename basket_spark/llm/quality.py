"""A quality classifier: random-indexing word vectors pooled over each document, then a two-layer network.

Each bucket of words has a fixed sparse index vector of -1, 0 and +1. A bucket's word vector is the sum of the index
vectors of the words around it, over all places of all documents; sums of whole numbers, so they come out alike however
Spark deals the rows. A document is the mean and the spread of the vectors of its words. A network with one hidden
layer, in numpy, is fitted to labelled rows; a temperature found on rows it wasn't fitted to calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, narrow, stored, utf8
from .lang_id import held_out

#: Buckets of the hash of words, and places of a vector.
BUCKETS = 1 << 15
DIMENSIONS = 32
#: Places of an index vector that aren't 0, and words to each side that count as around.
NONZERO = 4
WINDOW = 2
#: The classifier learns from so many labelled rows of either label at most, chosen by a hash of their id.
SAMPLE_PER_LABEL = 10_000
HIDDEN = 32
#: Numbers that the network gets of a document.
INPUTS = 2 * DIMENSIONS + 2
#: Steps of training, of BATCH rows each; passes over the sample at least.
STEPS, EPOCHS, BATCH = 4000, 20, 128
#: Temperatures that are tried; few rows without an error would ask for one near 0.
TEMPERATURES = np.geomspace(0.5, 20, 400)
#: A document counts as good from this score.
THRESHOLD = 0.7
#: Bytes of texts that are worked through at a time; a longer text is cut at the last blank before this, if it has one.
CHUNK = 1 << 20
_SEED = 13
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _classes() -> np.ndarray:
    """0: blank, 1: part of a word (letters, and all bytes beyond ASCII), 2: digits, 3: signs, each a word by itself."""
    kind = np.full(256, 3, np.uint8)
    for chars, n in ((b" \t\n\v\f\r", 0), (bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)), 1), (b"0123456789", 2)):
        kind[list(chars)] = n
    return kind


_KIND = _classes()


def index_vectors() -> np.ndarray:
    """BUCKETS x DIMENSIONS, drawn once by seed."""
    rng = np.random.default_rng(_SEED)
    places = np.argsort(rng.random((BUCKETS, DIMENSIONS)), 1)[:, :NONZERO]
    out = np.zeros((BUCKETS, DIMENSIONS), np.int8)
    np.put_along_axis(out, places, rng.choice(np.array([-1, 1], np.int8), places.shape), 1)
    return out


def word_buckets(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of each word of some texts, given as bytes one after the other and where each ends.

    A word's hash is a difference of running sums of powers, brought to its length, modulo 2^64.
    """
    kind = _KIND[data]
    opens = np.ones(len(data), bool)
    opens[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 3)
    opens[ends[(ends > 0) & (ends < len(data))]] = True
    starts = np.flatnonzero(opens)
    stops = np.append(starts[1:], len(data))
    live = kind[starts] != 0
    starts, stops = starts[live], stops[live]
    length = stops - starts
    hashes = np.zeros(len(starts), np.uint64)
    rest = np.arange(len(starts))
    for i in range(int(length.max(initial=0))):  # the i-th byte of every word that has one; long words are few
        rest = rest[length[rest] > i]
        if len(rest) < 64:
            break
        hashes[rest] = (hashes[rest] ^ data[starts[rest] + i]) * _FACTOR
        hashes[rest] ^= hashes[rest] >> np.uint64(29)
    else:
        rest = rest[:0]
    for at in rest.tolist():
        hashes[at] = _hash(data[starts[at] : stops[at]].tobytes())
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), np.searchsorted(ends, starts, "right")


def _hash(word: bytes) -> int:
    out = 0
    for byte in word:
        out = (out ^ byte) * int(_FACTOR) & 0xFFFFFFFFFFFFFFFF
        out ^= out >> 29
    return out


def _pieces(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The texts as (bytes, ends, their numbers), about CHUNK bytes at a time. How a text is cut depends on it alone."""
    held: list[tuple[int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        text = text or b""
        if len(text) > CHUNK:
            yield from (_joined([(i, part)]) for part in _cut(text))
        elif text:
            held.append((i, text))
            size += len(text)
        if size > CHUNK:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _cut(text: bytes) -> Iterator[bytes]:
    start = 0
    while len(text) - start > CHUNK:
        end = max(text.rfind(b" ", start, start + CHUNK), text.rfind(b"\n", start, start + CHUNK)) + 1
        end = end if end > start else start + CHUNK
        yield text[start:end]
        start = end
    yield text[start:]


def _joined(parts: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(t) for _, t in parts])
    return np.frombuffer(b"".join(t for _, t in parts), np.uint8), ends, np.array([i for i, _ in parts])


def contexts(buckets: np.ndarray, owner: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Sum of the index vectors of the words up to WINDOW places away in the same text, for each word."""
    out = np.zeros((len(buckets), DIMENSIONS), np.int8)
    vectors = index[buckets]
    for gap in range(1, WINDOW + 1):
        same = (owner[gap:] == owner[:-gap])[:, None]
        out[gap:] += vectors[:-gap] * same
        out[:-gap] += vectors[gap:] * same
    return out


def word_sums(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(bucket, v0, v1, ...): sums of the contexts of a bucket's words over all texts. Each task adds up its own first."""
    shared = docs.sparkSession.sparkContext.broadcast(index_vectors())
    names = [f"v{i}" for i in range(DIMENSIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, DIMENSIONS), np.int64)
        for batch in few(batches):
            for data, ends, _ in _pieces(utf8(batch["text"])):
                buckets, owner = word_buckets(data, ends)
                if len(buckets):
                    order = np.argsort(buckets, kind="stable")
                    first = np.flatnonzero(np.diff(buckets[order], prepend=-1))
                    total[buckets[order[first]]] += np.add.reduceat(contexts(buckets, owner, shared.value)[order], first, 0, np.int64)
        at = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(total[at, i]) for i in range(DIMENSIONS))], ["bucket", *names])

    rows = narrow(docs, text=text_col).mapInArrow(run, "bucket int, " + ", ".join(f"{n} long" for n in names))
    return rows.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names])


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """BUCKETS x DIMENSIONS: the sums at length 1, less their mean; buckets that no text has are 0."""
    got = word_sums(docs, text_col).toArrow()
    out = np.zeros((BUCKETS, DIMENSIONS))
    if got.num_rows:
        out[got["bucket"].to_numpy()] = np.stack([got[f"v{i}"].to_numpy() for i in range(DIMENSIONS)], 1)
    norm = np.sqrt((out * out).sum(1))
    live = norm > 0
    out[live] /= norm[live, None]
    if live.any():
        out[live] -= out[live].mean(0)
    return out.astype(np.float32)


def pooled(texts: list[bytes | None], vectors: np.ndarray) -> np.ndarray:
    """A row of INPUTS numbers for each text: the mean of its words' vectors, their spread in each place, the share of
    words that stand up to WINDOW places before too, and log(1 + words). A text without words is all 0."""
    n, again, sums, squares = np.zeros(len(texts)), np.zeros(len(texts)), np.zeros((len(texts), DIMENSIONS)), np.zeros((len(texts), DIMENSIONS))
    for data, ends, numbers in _pieces(texts):
        buckets, owner = word_buckets(data, ends)
        if len(buckets):
            own = vectors[buckets]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            at = numbers[owner[first]]
            np.add.at(n, at, np.diff(np.append(first, len(owner))))
            np.add.at(sums, at, np.add.reduceat(own, first, 0, np.float64))
            np.add.at(squares, at, np.add.reduceat(own * own, first, 0, np.float64))
            repeated = np.zeros(len(own), bool)
            for gap in range(1, WINDOW + 1):
                repeated[gap:] |= (buckets[gap:] == buckets[:-gap]) & (owner[gap:] == owner[:-gap])
            np.add.at(again, at, np.add.reduceat(repeated, first, dtype=np.int64))
    mean = sums / np.maximum(n, 1)[:, None]
    spread = np.sqrt(np.maximum(squares / np.maximum(n, 1)[:, None] - mean * mean, 0))
    return np.column_stack((mean, spread, again / np.maximum(n, 1), np.log1p(n)))


@dataclass
class Network:
    """tanh hidden layer on standardised inputs; the logit is divided by the temperature."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -500, 500)))


def _loss(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    return float((weight * (np.logaddexp(0, logit) - y * logit)).sum() / weight.sum())


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, hidden: int = HIDDEN) -> Network:
    """Adam on the weighted log loss, three quarters of the rows; the temperature of least loss on the rest.

    With one label only the probability is that label's whatever the text, with no rows it is one half.
    """
    rng, d = np.random.default_rng(_SEED), x.shape[1]
    zero = Network(np.zeros(d), np.ones(d), np.zeros((d, hidden)), np.zeros(hidden), np.zeros(hidden), 0.0)
    if len(set(y.tolist())) < 2:
        zero.b2 = 50.0 * (2 * y[0] - 1) if len(y) else 0.0
        return zero
    back = np.arange(len(y)) % 4 == 3  # rows come in the order of a hash
    if len(set(y[back].tolist())) < 2 or len(set(y[~back].tolist())) < 2:
        back = np.zeros(len(y), bool)
    fit = np.flatnonzero(~back)
    scale = x[fit].std(0)
    net = Network(x[fit].mean(0), np.where(scale > 1e-9, scale, 1.0), rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), 0.0)
    z = (x - net.centre) / net.scale
    values = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    epochs = max(EPOCHS, -(-STEPS * BATCH // len(fit)))
    for epoch in range(epochs):
        order = rng.permutation(fit)
        for start in range(0, len(order), BATCH):
            at = order[start : start + BATCH]
            h = np.tanh(z[at] @ values[0] + values[1])
            error = weight[at] * (1 / (1 + np.exp(-np.clip(h @ values[2] + values[3], -500, 500))) - y[at]) / weight[at].sum()
            inner = error[:, None] * values[2] * (1 - h * h)
            slopes = [z[at].T @ inner + 1e-3 * values[0], inner.sum(0), h.T @ error + 1e-3 * values[2], error.sum(keepdims=True)]
            step += 1
            rate = 5e-3 * (1 - epoch / epochs)
            for i, g in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                values[i] -= rate * first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = values[0], values[1], values[2], float(values[3][0])
    if back.any():
        logit = net.logit(x[back])
        net.temperature = min(TEMPERATURES, key=lambda t: _loss(logit / t, y[back], weight[back]))
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network


def _sample(labels: DataFrame, id_col: str, label_col: str, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, quality) of ``sample`` labelled ids of either label at most, and how many there are of each.

    Ids that are held out, null, or have labels of both kinds aren't used."""
    rows = narrow(labels, doc_id=id_col, quality=label_col).where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    rows = rows.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most").select("doc_id", F.col("quality").cast("int").alias("quality"))
    rows = stored(rows, "labels")
    counts = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    draw = [F.xxhash64(F.col("doc_id"), F.lit(_SEED)), F.col("doc_id")]
    return rows.where("quality = 0").orderBy(*draw).limit(sample).union(rows.where("quality = 1").orderBy(*draw).limit(sample)), counts


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE_PER_LABEL) -> Model:
    """Word vectors from the texts of all rows, a network from up to ``sample`` labelled documents of either label.

    A sampled document counts by the share of its label among all labelled ones, so probabilities hold for the table, not
    for the sample. Of rows of one id the one with the least digest of its text is learned from. The driver gets BUCKETS x
    DIMENSIONS sums and a row of INPUTS numbers for each sampled document; the sampled ids (2 x ``sample`` at most)
    are broadcast.
    """
    spark = docs.sparkSession
    vectors = word_vectors(docs, text_col)
    chosen, counts = _sample(labels, id_col, label_col, sample)
    chosen = stored(chosen, "sample")
    shared = spark.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            x = pooled(utf8(batch["text"]), shared.value)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["quality"], batch["digest"], pa.array(x.tolist(), pa.list_(pa.float64()))], ["doc_id", "quality", "digest", "x"])

    rows = narrow(docs, doc_id=id_col, text=text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, quality int, digest string, x array<double>")
    found = found.groupBy("doc_id").agg(F.min(F.struct("digest", "quality", "x")).alias("row"))
    got = found.select("row.quality", "row.x").orderBy(F.xxhash64(F.col("doc_id"), F.lit(_SEED)), "doc_id").toArrow()
    y = got["quality"].to_numpy().astype(float)
    x = np.array(got["x"].to_pylist()).reshape(len(y), INPUTS)
    share = [counts.get(k, 0) / max((y == k).sum(), 1) for k in (0, 1)]
    return Model(vectors, train(x, y, np.where(y == 1, share[1], share[0])))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, from its whole text alone.

    Null texts are empty; texts without words all get the same score. Null ids aren't held out. Repeated rows each give a
    row, an empty table none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            p = shared.value.network.probability(pooled(utf8(batch["text"]), shared.value.vectors))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")
