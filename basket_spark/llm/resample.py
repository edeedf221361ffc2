"""Importance resampling towards a target distribution over hashed n-grams, by the CRC of substrings.

A document's words are joined by single blanks and scanned once: the running CRC-32 is stored at each word's start and
end. With these two values the CRC of any run of words follows without reading it again, since appending L bytes to a
prefix multiplies its CRC by x^(8L) modulo the CRC's polynomial over GF(2): shifting the CRC at the start by the length
and adding it to the one at the end cancels the prefix. Buckets of the n-grams are counted over the raw documents and the
target texts; log ratios of the smoothed shares weigh each n-gram, and Gumbel noise keyed by the id makes the draw
without replacement a plain ranking.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_rank
from .common import few, narrow, stored, utf8

BUCKETS = 10_000
#: Words of the longest n-grams.
NGRAM = 1
LEAST_WORDS = 20
DRAWN_PERCENT = 10
SEED = 2024
POLYNOMIAL = 0xEDB88320
#: Shifts by fewer bytes than this have a table each; longer ones go bit by bit.
SHORT = 64
#: Words of a long text that are worked through at a time.
WORDS = 1 << 16
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters a to z (A to Z lower-cased) and all characters beyond ASCII, in UTF-8."""
    return text.translate(_FOLD).split()


@lru_cache(1)
def _one_byte() -> np.ndarray:
    """What appending a zero byte makes of each of the 32 bits of a CRC: the columns of a matrix over GF(2)."""
    columns = []
    for bit in range(32):
        c = 1 << bit
        for _ in range(8):
            c = c >> 1 ^ (POLYNOMIAL if c & 1 else 0)
        columns.append(c)
    return np.array(columns, np.uint32)


def _times(matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The matrix (32 columns) times each of the values, over GF(2)."""
    bits = (values[..., None] >> np.arange(32, dtype=np.uint32)) & 1
    return np.bitwise_xor.reduce(np.where(bits == 1, matrix, np.uint32(0)), -1)


def _bytewise(matrix: np.ndarray) -> np.ndarray:
    """The same as 4 x 256 products of each byte of a CRC in its place."""
    return np.stack([_times(matrix, np.arange(256, dtype=np.uint32) << np.uint32(8 * k)) for k in range(4)])


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Byte-wise products of the shifts by 0 to SHORT - 1 bytes, and by SHORT times the powers of two up to 2^25: 1024
    numbers each, one after the other."""
    one, power, short = _one_byte(), np.uint32(1) << np.arange(32, dtype=np.uint32), []
    for _ in range(SHORT):
        short.append(_bytewise(power))
        power = _times(one, power)
    long = []
    for _ in range(26):
        long.append(_bytewise(power))
        power = _times(power, power)
    return np.stack(short).ravel(), np.stack(long).ravel()


def _apply(table: np.ndarray, offsets: np.ndarray | int, crcs: np.ndarray) -> np.ndarray:
    """The products of the table at ``offsets`` (one for all, or one for each) with the CRCs."""
    out = table[offsets + (crcs & np.uint32(255))]
    for k in (1, 2, 3):
        out ^= table[offsets + (crcs >> np.uint32(8 * k) & np.uint32(255)) + 256 * k]
    return out


def shift(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC after its number of bytes have followed, less what those bytes add themselves. Lengths below 2^32."""
    short, long = _tables()
    out, rest, bit = _apply(short, (lengths % SHORT) * 1024, crcs), lengths // SHORT, 0
    while rest.any():
        at = np.flatnonzero(rest & 1)
        out[at] = _apply(long, 1024 * bit, out[at])
        rest, bit = rest >> 1, bit + 1
    return out


class PrefixCrcs:
    """Running CRCs of words joined by blanks: ``crc_start[i]`` just before word i, ``crc_end[i]`` just behind it."""

    def __init__(self, words: list[bytes]):
        n = len(words)
        running = accumulate(words[1:], lambda crc, word: crc32(word, crc32(b" ", crc)), initial=crc32(words[0])) if n else ()
        self.crc_end = np.fromiter(running, np.uint32, n)
        self.crc_start = np.zeros(n, np.uint32)  # a blank behind the word before: the CRC shifted by a byte, plus the blank's
        self.crc_start[1:] = _apply(_tables()[0], 1024, self.crc_end[:-1]) ^ np.uint32(crc32(b" "))
        lengths = np.fromiter(map(len, words), np.int64, n)
        self.end = np.cumsum(lengths + 1) - 1
        self.start = self.end - lengths

    def ngrams(self, n: int) -> np.ndarray:
        """The CRC of each run of n words."""
        if len(self.end) < n:
            return np.zeros(0, np.uint32)
        starts, ends = slice(0, len(self.end) - n + 1), slice(n - 1, None)
        return self.crc_end[ends] ^ shift(self.crc_start[starts], self.end[ends] - self.start[starts])


def buckets_of(text: bytes, n_max: int = NGRAM, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Buckets of all runs of 1 to ``n_max`` words, in bounded pieces: pieces of a long text overlap by n_max - 1 words."""
    words = words_of(text)
    for at in range(0, len(words), WORDS):
        piece = PrefixCrcs(words[at : at + WORDS + n_max - 1])
        for n in range(1, n_max + 1):
            yield piece.ngrams(n)[:WORDS].astype(np.int64) % buckets


def bucket_counts(texts: DataFrame, text_col: str = "text", n_max: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over the n-grams of all texts; null texts have none. Each task adds up its own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in few(batches):
            for text in utf8(batch["text"]):
                for own in buckets_of(text or b"", n_max, buckets):
                    total += np.bincount(own, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    return narrow(texts, text=text_col).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket, from the counts of raw (s, S) and
    target (t, T): ``buckets`` numbers, the only ones that the driver gets."""
    spark = raw.sparkSession
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    both = every.join(raw.toDF("bucket", "s"), "bucket", "left").join(target.toDF("bucket", "t"), "bucket", "left").select("bucket", zero(F.col("s")).alias("s"), zero(F.col("t")).alias("t"))
    got = both.toArrow().sort_by("bucket")
    s, t = (got[c].to_numpy() for c in ("s", "t"))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", n_max: int = NGRAM) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row: the sum of the gains of its n-grams, 0 without any."""
    shared, buckets = docs.sparkSession.sparkContext.broadcast(gain), len(gain)
    rows = narrow(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            out = []
            for text in utf8(batch["text"]):
                n, weight, n_words = 0, 0, 0
                for i, own in enumerate(buckets_of(text or b"", n_max, buckets)):
                    n, weight, n_words = n + len(own), weight + int(shared.value[own].sum()), n_words + (0 if i % n_max else len(own))
                out.append((n_words, n, weight))
            columns = zip(*out, strict=True) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def noise(doc_id: str, seed: int = SEED) -> F.Column:
    """floor(1000 x Gumbel noise) from the first 32 bits of sha256(``seed:id``)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", n_max: int = NGRAM, percent: int = DRAWN_PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; rank is that of the drawn ones, null for the others.

    Of the N rows with ``LEAST_WORDS`` words, floor(percent N / 100) of the highest score (weight plus noise) are drawn, ties
    to the smaller id, then the fewer features; null ids come after all others and have the noise of an empty id.
    Repeated rows each count and each get a rank. Null and empty texts have no features and are never drawn. All documents
    and all target texts are counted; an empty target has counts of 0.
    """
    gain = gains(bucket_counts(docs, text_col, n_max), bucket_counts(target, target_text_col, n_max))
    rows = weights(docs, gain, id_col, text_col, n_max).withColumn("score", F.col("weight") + noise("doc_id", seed))
    rows = stored(rows, "weights")
    fits = rows.where(F.col("n_words") >= LEAST_WORDS).drop("n_words").withColumn("nameless", F.col("doc_id").isNull())
    ranked = global_rank(fits, {"score": "desc", "nameless": "asc", "doc_id": "asc", "n_features": "asc"})
    drawn = fits.count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return ranked.union(rows.where(F.col("n_words") < LEAST_WORDS).select(*columns, F.lit(None).cast("long")))
