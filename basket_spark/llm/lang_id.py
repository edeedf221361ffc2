"""Language identification with error-correcting output codes.

Each language gets a codeword; one binary naive-Bayes classifier over hashed character n-grams predicts each bit.
Decoding is loss-weighted: the loss of every bit counts by how well its classifier did on the rows of that language
held back from counting, and the language of the least loss wins. A prediction is ambiguous when the best two are close.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, narrow

#: Buckets of the n-gram hash: 2 to this power.
BUCKET_BITS = 16
#: At most about this many labelled rows of each language are learned from, chosen by a hash of their id.
SAMPLE_PER_LANGUAGE = 3000
#: A prediction is ambiguous when its score leads the next by less.
AMBIGUITY_GAP = 0.2
#: A filter rejects a text when the lead is less than this: the two best come out alike.
REJECT_GAP = 0.05
UNDETERMINED = "und"
#: More labels than this aren't languages; it bounds what the driver gets.
MAX_LANGUAGES = 256
_BUCKETS = 1 << BUCKET_BITS
_CHUNK = 1 << 18


@dataclass
class Model:
    """What the classifiers learned; its size depends on the number of languages and buckets alone."""

    languages: list[str]
    codes: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int8))  # language x bit, +1 or -1
    weights: np.ndarray = field(default_factory=lambda: np.zeros((_BUCKETS, 0), np.float32))  # bucket x bit
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))  # of each bit's margin
    centre: np.ndarray = field(default_factory=lambda: np.zeros(0))
    trust: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # language x bit


def codewords(n: int) -> np.ndarray:
    """``n`` codewords of +1 and -1: every split of the languages up to seven of them, else the best of some seeded
    random codes of 10 log2(n) bits by least distance."""
    if n < 2:
        return np.ones((n, 0), np.int8)
    if n <= 7:
        splits = np.arange(1, 1 << (n - 1))
        return np.where((splits[None, :] >> (n - 1 - np.arange(n))[:, None]) & 1, 1, -1).astype(np.int8)
    rng, bits, best, least = np.random.default_rng(20), int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        dots = code.astype(int) @ code.T.astype(int)
        apart = (bits - np.abs(dots[np.triu_indices(n, 1)]).max()) / 2
        if apart > least and (np.abs(code.sum(0)) < n).all():
            best, least = code, apart
    return best


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str) -> Iterator[np.ndarray]:
    """Hash buckets of the n-grams of two to four characters of the lower-cased text, in bounded chunks.

    Runs of other characters than letters count as one blank. Nothing comes of a text without letters.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[points]
    if not is_letter.any():
        return
    points = np.where(is_letter, points, 32)
    blank = ~is_letter
    points = np.concatenate(([32], points[~(blank & np.concatenate(([True], blank[:-1])))], [32])).astype(np.uint64)
    for start in range(0, len(points), _CHUNK):
        part = points[start : start + _CHUNK + 3]
        found = []
        key = part
        for n in (2, 3, 4):
            if len(part) < n:
                break
            key = key[:-1] * np.uint64(0x110001) + part[n - 1 :]
            live = key[: _CHUNK] if len(key) > _CHUNK else key
            found.append((((live + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        if found:
            yield np.concatenate(found)


def histogram(text: str) -> np.ndarray | None:
    """Counts of the buckets, or None without letters."""
    total = None
    for part in grams(text):
        counts = np.bincount(part, minlength=_BUCKETS)
        total = counts if total is None else total + counts
    return total


def margins(model: Model, text: str) -> np.ndarray | None:
    """Mean log-odds of each bit over the n-grams of the text, or None without letters."""
    total, n = 0.0, 0
    for part in grams(text):
        total, n = total + model.weights[part].sum(0, dtype=np.float64), n + len(part)
    return total / n if n else None


def predict(model: Model, text: str | None, gap: float = AMBIGUITY_GAP) -> tuple[str, float, bool]:
    """(language, score 0 to 1, ambiguous: whether the lead is below ``gap``). `und`, 0, True for a null text, one without letters or no languages."""
    if not text or not model.languages or (margin := margins(model, text)) is None:
        return UNDETERMINED, 0.0, True
    if len(model.languages) == 1:
        return model.languages[0], 1.0, False
    signed = model.codes * ((margin - model.centre) / model.scale)[None, :]
    loss = (model.trust * np.logaddexp(0, -2 * signed)).sum(1) * model.codes.shape[1]
    share = np.exp(loss.min() - loss)
    share /= share.sum()
    first, second = np.argsort(-share, kind="stable")[:2]
    return model.languages[first], float(share[first]), bool(share[first] - share[second] < gap)


def held_out(doc_id: str) -> F.Column:
    """Whether a row is left out of learning: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn from the rows that aren't held out and have text and language: about ``sample`` of each language.

    Three quarters of them give the n-gram counts, the rest the scale and the trust of each bit. Rows with a null id
    aren't learned from. The counts are summed in Spark; the driver gets languages x buckets numbers at most, and more than
    ``MAX_LANGUAGES`` labels raise.
    """
    rows = narrow(docs, id=id_col, text=text_col, lang=lang_col).where(F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("text").isNotNull() & ~held_out("id"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    languages = sorted(counts)
    if not languages:
        return Model([])
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    place = {k: i for i, k in enumerate(languages)}
    quota = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, sample / counts[k]))])
    rows = rows.where(draw < quota[F.col("lang")]).select("lang", "text", (F.pmod(F.xxhash64(F.col("id"), F.lit(8)), F.lit(4)) == 0).alias("back"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in few(batches):
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if (own := histogram(text)) is not None:
                    sums[lang] = sums.get(lang, 0) + own / own.sum()  # each text counts alike
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), place[lang], np.int32)), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "bucket", "n"])

    got = rows.where("NOT back").mapInArrow(count, "lang int, bucket int, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # 16 bytes a row
    table = np.zeros((len(languages), _BUCKETS))
    if got.num_rows:
        table[got["lang"].to_numpy(), got["bucket"].to_numpy()] = got["n"].to_numpy()
    table /= np.maximum(table.sum(1, keepdims=True), 1e-12)
    codes = codewords(len(languages))
    bits, least = codes.shape[1], 1e-6
    weights = np.empty((_BUCKETS, bits), np.float32)
    for b in range(bits):
        weights[:, b] = np.log(table[codes[:, b] > 0].mean(0) + least) - np.log(table[codes[:, b] < 0].mean(0) + least)
    model = Model(languages, codes, weights, np.ones(bits), np.zeros(bits), np.full((len(languages), bits), 1 / max(bits, 1)))
    if bits:
        model = _calibrated(model, rows)
    return model


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """Set centre, scale and trust from the rows of the sample that were held back."""
    shared, place = rows.sparkSession.sparkContext.broadcast(model), {k: i for i, k in enumerate(model.languages)}

    def margin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            found = [(k, m.tolist()) for k, x in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True) if (m := margins(shared.value, x)) is not None]
            yield pa.RecordBatch.from_pydict({"lang": [k for k, _ in found], "m": [m for _, m in found]}, pa.schema([("lang", pa.string()), ("m", pa.list_(pa.float64()))]))

    got = rows.where("back").mapInArrow(margin, "lang string, m array<double>").toArrow()
    if not got.num_rows:
        return model
    who, m = np.array([place[k] for k in got["lang"].to_pylist()]), np.array(got["m"].to_pylist())
    truth = model.codes[who]
    for b in range(m.shape[1]):
        up, down = m[truth[:, b] > 0, b], m[truth[:, b] < 0, b]
        if len(up) and len(down):
            model.centre[b] = (np.median(up) + np.median(down)) / 2
            model.scale[b] = max((np.median(up) - np.median(down)) / 4, 1e-6)
    right = np.sign(m - model.centre) == truth
    trust = np.stack([right[who == i].mean(0) if (who == i).any() else np.ones(m.shape[1]) for i in range(len(model.languages))])
    model.trust = (trust + 1e-3) / (trust + 1e-3).sum(1, keepdims=True)
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of every row, from its whole text.

    Null ids give a null ``doc_id`` and ``held_out`` false. Repeated rows each give a row; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            out = [predict(shared.value, x) for x in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()), pa.array([x[2] for x in out], pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    rows = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language can be told: text with letters, and not so mixed that the two
    best languages come out alike (equal to within ``REJECT_GAP`` of their shares). A model that learned no language tells
    nothing: all rows stay."""
    if not model.languages:
        return docs
    shared, schema = docs.sparkSession.sparkContext.broadcast(model), docs.schema
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            out = [predict(shared.value, x, REJECT_GAP) for x in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([lang != UNDETERMINED and not unsure for lang, _, unsure in out], pa.bool_()))

    return docs.mapInArrow(run, schema)
