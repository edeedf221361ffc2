"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for two bases modulo 2^31 - 1, the hash of each of its prefixes. Any two spans, of one
text or of two, are equal if their hashes, brought to the same power, are; binary search over lengths finds the longest
common extension of two places. A fingerprint holds the length, the hashes of the prefixes at multiples of a stride, at
most 64 of them, and of the whole, and those of the suffixes of such lengths, brought to power 0; two fingerprints compare
by their longest common prefix and suffix, whatever the lengths of the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampType

from .common import few, narrow

MOD = np.uint64((1 << 31) - 1)
BASES = (np.uint64(1_000_003), np.uint64(777_767_777))
#: A fingerprint has at most so many spans.
SPANS = 64
#: Rows that are taken apart at a time.
ROWS = 1024
_INVERSES = tuple(np.uint64(pow(int(b), -1, int(MOD))) for b in BASES)
_powers = [np.ones(1, np.uint64) for _ in BASES]


def powers(n: int) -> list[np.ndarray]:
    """The bases to the powers 0 to n (at least)."""
    while len(_powers[0]) <= n:
        for k, base in enumerate(BASES):
            top = _powers[k][-1] * base % MOD
            _powers[k] = np.concatenate((_powers[k], _powers[k] * top % MOD))
    return _powers


def inverse_powers(k: int, start: int, step: int, count: int) -> np.ndarray:
    """The inverse of base k to the powers start, start + step, ...: as many as ``count``."""
    jump, out = np.uint64(pow(int(_INVERSES[k]), step, int(MOD))), np.array([pow(int(_INVERSES[k]), start, int(MOD))], np.uint64)
    while len(out) < count:
        out, jump = np.concatenate((out, out * jump % MOD)), jump * jump % MOD
    return out[:count]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


class Prefixes:
    """Prefix hashes of a sequence of code points: ``at[k][i]`` is that of the first i under base k."""

    def __init__(self, at: list[np.ndarray]) -> None:
        self.at, self.n = at, len(at[0]) - 1

    @classmethod
    def of(cls, text: str) -> Prefixes:
        found = points(text)
        power, out = powers(len(found)), []
        for k in range(len(BASES)):
            sums = np.zeros(len(found) + 1, np.uint64)
            np.cumsum(found * power[k][: len(found)] % MOD, out=sums[1:])  # below 2^64 up to 2^33 code points
            out.append(sums % MOD)
        return cls(out)

    def edited(self, cut: int, other: Prefixes, m: int) -> Prefixes:
        """Of the first ``cut`` code points and then the first ``m`` of ``other``, from the arrays of both."""
        power = powers(self.n + m)
        return Prefixes([np.concatenate((a[: cut + 1], (a[cut] + power[k][cut] * b[1 : m + 1]) % MOD)) for k, (a, b) in enumerate(zip(self.at, other.at, strict=True))])

    def span(self, start: int, end: int, power: int) -> tuple[int, ...]:
        """Hash of [start, end) at ``power`` (at least start)."""
        table = powers(power)
        return tuple(int((a[end] + MOD - a[start]) % MOD * table[k][power - start] % MOD) for k, a in enumerate(self.at))

    def equal(self, i: int, other: Prefixes, j: int, length: int) -> bool:
        """Whether the spans of this length at i here and at j there are equal."""
        top = max(i, j)
        return i + length <= self.n and j + length <= other.n and self.span(i, i + length, top) == other.span(j, j + length, top)

    def extension(self, i: int, other: Prefixes, j: int) -> int:
        """Length of the longest common extension of i here and j there."""
        return _longest(min(self.n - i, other.n - j), lambda length: self.equal(i, other, j, length))

    def fingerprint(self) -> str:
        """Length, then the hashes of the prefixes at the multiples of the stride and at the end, then those of the suffixes
        of the stride's multiples, in hexadecimal.

        The stride is the least power of two that gives at most ``SPANS`` spans, so strides of different lengths nest.
        """
        step = stride(self.n)
        ends = np.append(np.arange(step, self.n, step), self.n)
        starts = np.arange(self.n - step, 0, -step)
        first = [a[ends] for a in self.at]
        last = [(a[-1] + MOD - a[starts]) % MOD * inverse_powers(k, int(starts[-1]), step, len(starts))[::-1] % MOD if len(starts) else a[:0] for k, a in enumerate(self.at)]
        return f"{self.n:x}:" + ":".join(np.stack(side, 1).astype(">u4").tobytes().hex() for side in (first, last))


def stride(n: int) -> int:
    return 1 << max(0, (-(-n // SPANS) - 1).bit_length()) if n > SPANS else 1


def _read(fingerprint: str) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Length, stride, and the hashes of prefixes and of suffixes; place i is that of i spans."""
    n, *sides = fingerprint.split(":")
    first, last = (np.concatenate(([np.uint64(0)], np.frombuffer(bytes.fromhex(x), ">u8").astype(np.uint64))) for x in sides)
    return int(n, 16), stride(int(n, 16)), first, last


def _longest(most: int, equal: Callable[[int], bool]) -> int:
    """The largest length up to ``most`` that ``equal`` holds for; it holds for all shorter ones too."""
    low = 0
    while low < most:
        mid = (low + most + 1) // 2
        low, most = (mid, most) if equal(mid) else (low, mid - 1)
    return low


def likeness(one: str, two: str) -> float:
    """Share of the longer text that the fingerprints show as common prefix and common suffix, to within a stride each.

    1 for equal fingerprints, and for two empty texts; 0 if one is empty. Prefix and suffix don't count twice: they cover
    the shorter text at most. What is common elsewhere isn't seen.
    """
    if one == two:
        return 1.0
    (n, s, first, last), (m, t, other_first, other_last) = _read(one), _read(two)
    if not n or not m:
        return 0.0
    step, least = max(s, t), min(n, m)
    spans = (least - 1) // step  # the whole of a text has a hash among the prefixes only, at no multiple of the stride
    common = [_longest(spans, lambda i, a=a, b=b: bool(a[i * step // s] == b[i * step // t])) for a, b in ((first, other_first), (last, other_last))]
    if least == n and n % t == 0 and first[-1] == other_first[n // t] or least == m and m % s == 0 and other_first[-1] == first[m // s]:
        return least / max(n, m)  # the shorter one is a prefix
    return min(least, sum(common) * step) / max(n, m)


def _bounds(rows: DataFrame, n: int) -> list:
    """Bounds of about n equal ranges of the ids."""
    if not isinstance(rows.schema["doc_id"].dataType, (NumericType, DateType, TimestampType)):
        raise ValueError("ids must be numbers or dates, as documents follow each other by id")
    return sorted(set(rows.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n).alias("q")).first()[0] or []))


def _place(bounds: list) -> F.Column:
    """Number of the range of ``doc_id``, found in two steps; null ids are in the first."""
    if not bounds:
        return F.lit(0)
    wide = max(1, int(len(bounds) ** 0.5))
    below = lambda b: b <= F.col("doc_id")
    coarse = F.array_size(F.filter(F.array([F.lit(b) for b in bounds[wide - 1 :: wide]]), below)) * wide
    return F.coalesce(coarse + F.array_size(F.filter(F.slice(F.array([F.lit(b) for b in bounds]), coarse + 1, wide), below)), F.lit(0))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, common_next) of every row.

    The edited text has the last floor(n_chars/4) code points replaced by the first as many (or all) of the next row's
    text, by ascending id, after the last the first. ``common_next`` is the exact number of code points that the row's and
    the next row's text begin with alike. Null texts are empty. Rows of one id are ordered by their text, null ids come
    first; a single row is its own next. Ids must be numbers or dates; others raise.

    Rows go to ranges of ids, sorted, and each range gets a copy of the row that follows it, so no task sees more than
    its range; the driver sees the ranges' bounds and their least ids alone.
    """
    spark = docs.sparkSession
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    bounds = _bounds(rows, max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = rows.withColumn("part", _place(bounds))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # The first row of each range in use also goes, as the last, to the range before it; that of the first to the last.
    least = {r["part"]: r["least"] for r in rows.groupBy("part").agg(F.min("doc_id").alias("least"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).select("part", F.when(F.col("nulls") == 0, F.col("least")).alias("least")).collect()}
    used = sorted(least)
    firsts = spark.createDataFrame([(p, least[p], used[i - 1]) for i, p in enumerate(used)], f"part int, least {kind}, before int")
    heads = rows.join(F.broadcast(firsts), "part").where(F.col("doc_id").eqNullSafe(F.col("least"))).groupBy("before", "doc_id").agg(F.min("text").alias("text"))
    dealt = rows.select("doc_id", "text", "part", F.lit(0).alias("after")).union(heads.select("doc_id", "text", "before", F.lit(1)))
    dealt = dealt.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", "after", F.col("doc_id").asc_nulls_first(), "text")
    return dealt.mapInArrow(_walk, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_next long")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a range with the one after it; a range's last row is the copy of the next range's first."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_next"]
    last = None
    for batch in few(batches, ROWS):
        out: list[tuple] = []
        for doc_id, text, part, after in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "part", "after")), strict=True):
            own = Prefixes.of(text)
            now = (doc_id, text, own, own.fingerprint(), part)
            if last is not None and last[4] == part:
                out.append(_row(last, now))
            last = None if after else now
        if out:
            arrays = [pa.array(x) for x in zip(*out, strict=True)]
            arrays[0] = pa.array([x[0] for x in out], batch["doc_id"].type)
            yield pa.RecordBatch.from_arrays(arrays, names)


def _row(now: tuple, following: tuple) -> tuple:
    doc_id, text, own, mark, _ = now
    _, other, theirs, next_mark, _ = following
    cut = own.n - own.n // 4
    m = min(own.n // 4, theirs.n)
    edited = own.edited(cut, theirs, m).fingerprint()
    digest = hashlib.sha256((text[:cut] + other[:m]).encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, own.n, digest, mark, edited, likeness(mark, edited), likeness(mark, next_mark), own.extension(0, theirs, 0)
