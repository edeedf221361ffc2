"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

Two permutations of a universe of 2^20 make all coordinates: the first scatters the shingles, the second, shifted
circularly by k, gives coordinate k. Shifts of a shingle are neighbours in the second permutation, so a shingle's
values for all coordinates are one slice of it.

Work on equal sets is done once: documents of one shingle set are a class, and its least id stands for it. In each
bucket every class is compared with the bucket's centre, the member that shares most buckets (a star, not all pairs).
What a star leaves apart is compared further only where sizes or shared shingles outside the centre allow a link:

* Two members that share no shingle outside the centre have at most min(x, y) / (max(x, y) + what either has outside) in
  common, x and y being their shares of the centre.
* Otherwise a link needs 0.8 |X| - x shared shingles outside at least, so the two share one among the rarest of them
  (a prefix filter).

Links hold on full shingle sets only.

What a key's rows are joined with is always written first and not aggregated in the same stage, so that Spark can split
the rows of a class, bucket or component that holds a third of them over tasks. Rows without words meet nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, narrow, stored, utf8
from .components import connected_components

UNIVERSE = 1 << 20
#: 48 bands of 6 coordinates: a pair of Jaccard 0.8 shares no bucket with a chance under 5 in ten million.
BANDS, ROWS = 48, 6
SIMILARITY = 80  # in hundredths
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_KEPT_WORDS = 1 << 16


class _WordHashes(dict):
    """64-bit hashes of words; the table is emptied when it gets large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_word_hash = _WordHashes()
_permutations: list[np.ndarray] = []


def permutations() -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and for each place the values of all coordinates (windows of the second one)."""
    if not _permutations:
        rng = np.random.default_rng(2)
        first, second = (rng.permutation(UNIVERSE).astype(np.uint32) for _ in range(2))
        around = np.concatenate((second, second[: BANDS * ROWS]))
        _permutations.extend((first, np.lib.stride_tricks.sliding_window_view(around, BANDS * ROWS)))
    return _permutations[0], _permutations[1]


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words; with fewer words the whole sequence is one.

    A-Z is lower-cased; words are split at blanks and the control characters 9 to 13, as ``bytes`` does.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_word_hash.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    value = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        value = (value ^ hashes[i : i + len(value)]) * _PRIME
        value ^= value >> np.uint64(29)
    return np.unique(value)


def band_keys(found: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band of the signature."""
    first, windows = permutations()
    places, least = first[found % np.uint64(UNIVERSE)], None
    for start in range(0, len(places), 1024):
        part = windows[places[start : start + 1024]].min(0)
        least = part if least is None else np.minimum(least, part)
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    for i in range(ROWS):
        key = (key ^ rows[:, i]) * _PRIME
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """(id, n, hi, lo, bands) of each row: size of its set, 128 bits that stand for the set, its buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            n, hi, lo, bands = [], [], [], []
            for text in utf8(batch["text"]):
                found = shingles(text, words)
                n.append(len(found))
                mark = np.frombuffer(xxhash.xxh128_digest(found.tobytes()), ">i8") if len(found) else (None, None)
                hi.append(None if mark[0] is None else int(mark[0]))
                lo.append(None if mark[1] is None else int(mark[1]))
                bands.append(band_keys(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], ["id", "n", "hi", "lo", "bands"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n long, hi long, lo long, bands array<long>")


def _similar(x: str, y: str) -> F.Column:
    """Whether sets of these sizes can be similar enough."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * SIMILARITY


def _compared(pairs: DataFrame, texts: DataFrame, words: int, outside: bool = False) -> DataFrame:
    """(a, b, both, link) of pairs (a, b): size of the intersection of their full shingle sets, and whether they are similar
    enough; with ``outside`` also the shingles of b that a hasn't. ``texts``: (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, np.zeros(0, np.uint64)
        for batch in few(batches):
            both, link, more = [], [], []
            for one, two in zip(utf8(batch["one"]), utf8(batch["two"]), strict=True):
                if one != last:
                    last, own = one, shingles(one, words)
                other = shingles(two, words)
                n = len(np.intersect1d(own, other, assume_unique=True))
                both.append(n)
                link.append(n > 0 and 100 * n >= SIMILARITY * (len(own) + len(other) - n))
                if outside:
                    more.append(np.setdiff1d(other, own, assume_unique=True).view(np.int64))
            out = [batch["a"], batch["b"], pa.array(both, pa.int64()), pa.array(link, pa.bool_())]
            names = ["a", "b", "both", "link"]
            yield pa.RecordBatch.from_arrays([*out, pa.array(more, pa.list_(pa.int64()))], [*names, "outside"]) if outside else pa.RecordBatch.from_arrays(out, names)

    kind = pairs.schema["a"].dataType.simpleString()
    joined = pairs.join(texts.toDF("b", "two"), "b").join(texts.toDF("a", "one"), "a")
    return joined.select("a", "b", "one", "two").mapInArrow(run, f"a {kind}, b {kind}, both long, link boolean" + ", outside array<long>" * outside)


def _members(classes: DataFrame) -> DataFrame:
    """(bucket, id, n, centre) of the classes that share a bucket with others."""
    spread = classes.select("id", "n", F.explode("bands").alias("bucket"))
    shared = stored(spread.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "shared")
    found = stored(spread.join(shared, "bucket"), "members")
    degree = found.groupBy("id").agg(F.sum("size").alias("degree"))
    centres = stored(found.join(degree, "id").groupBy("bucket").agg(F.min(F.struct((-F.col("degree")).alias("d"), "id")).alias("c")), "centres")
    return stored(found.join(centres, "bucket").select("bucket", "id", "n", F.col("c.id").alias("centre")), "centred")


def _links(members: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Edges (a, b) that give the components of the links between the members of all buckets."""
    stars = stored(_compared(members.where("id != centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct(), texts, words, outside=True), "stars")
    joined = connected_components(stars.where("link").select("a", "b"))
    placed = members.join(joined.toDF("id", "component"), "id", "left").select("bucket", "id", "n", "centre", F.coalesce("component", "id").alias("component"))
    placed = stored(placed, "placed")
    largest = placed.groupBy("bucket", "component").agg(F.count("*").alias("size")).groupBy("bucket").agg(F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    largest = stored(largest.select("bucket", F.col("top.component").alias("largest")), "largest")
    sizes = stars.select(F.col("a").alias("centre"), F.col("b").alias("id"), F.col("both").alias("inside"), F.size("outside").cast("long").alias("extra"))
    open_ = placed.join(largest, "bucket").join(sizes, ["centre", "id"], "left")
    open_ = stored(open_.select("bucket", "centre", "id", "n", "component", (F.col("component") != F.col("largest")).alias("apart"), F.coalesce("inside", "n").alias("inside"), F.coalesce("extra", F.lit(0)).alias("extra")), "open")
    if open_.where("apart").isEmpty():  # every bucket is one component
        return joined.toDF("a", "b")
    rest = _sharing_the_centre(open_).union(_sharing_more(open_, stars)).distinct()
    known = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = _compared(rest.join(known, ["a", "b"], "left_anti"), texts, words).where("link").select("a", "b")
    return joined.toDF("a", "b").union(found)


def _pairs(rows: DataFrame, on: list[str], condition: F.Column) -> DataFrame:
    """Distinct (a < b) of rows in different components, one of them apart from its bucket's largest, of like sizes.

    Rows only meet those of like sizes: sizes are dealt into bands so wide (1.26 to 1) that similar ones lie in the same
    or in neighbouring bands, and a row that is apart goes to three.
    """
    band = F.floor(F.log("n") / F.log(F.lit(1.26)))
    other = rows.where("apart").select(*on, *[F.col(c).alias(f"{c}_1") for c in rows.columns if c not in on], F.explode(F.sequence(band - 1, band + 1)).alias("band"))
    joined = other.join(rows.withColumn("band", band), [*on, "band"]).where((F.col("component") != F.col("component_1")) & _similar("n", "n_1") & condition)
    return joined.select(F.least("id", "id_1").alias("a"), F.greatest("id", "id_1").alias("b")).distinct()


def _sharing_the_centre(open_: DataFrame) -> DataFrame:
    """Pairs of a bucket that could be linked by shingles of the centre alone."""
    bound = F.least("inside", "inside_1") * 100 >= (F.greatest("inside", "inside_1") + F.col("extra") + F.col("extra_1")) * SIMILARITY
    possible = open_.where(F.col("inside") * 100 >= (F.col("inside") + F.col("extra")) * SIMILARITY)
    return _pairs(possible, ["bucket"], bound)


def _sharing_more(open_: DataFrame, stars: DataFrame) -> DataFrame:
    """Pairs of a centre that share one of the rarest shingles outside it, as many as a link leaves room for."""
    rows = open_.groupBy("centre", "id", "n", "component", "inside").agg(F.max("apart").alias("apart"))
    spread = rows.join(stars.select(F.col("a").alias("centre"), F.col("b").alias("id"), "outside"), ["centre", "id"])
    spread = spread.select("centre", "id", "n", "component", "apart", "inside", F.explode("outside").alias("shingle"))
    often = spread.groupBy("centre", "shingle").agg(F.count("*").alias("often"), F.max("apart").alias("any")).where("often > 1 AND any")
    often = stored(often, "often")
    # Shingles that no other has come first in the order and pair with nothing: it is enough to count them.
    common = spread.join(often, ["centre", "shingle"])
    each = common.groupBy("centre", "id", "n", "component", "apart", "inside").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("common"))
    needed = F.greatest(F.lit(1), F.ceil((F.col("n") * SIMILARITY - F.col("inside") * 100) / 100)).cast("int")
    # Of the m = n - inside shingles outside the first m - needed + 1 are the prefix; m - size(common) of them are alone.
    room = F.size("common") - needed + 1
    prefix = each.where(room > 0).select("centre", "id", "n", "component", "apart", F.explode(F.slice("common", F.lit(1), room)).alias("s")).select("centre", "id", "n", "component", "apart", F.col("s.shingle").alias("shingle"))
    return _pairs(prefix, ["centre", "shingle"], F.lit(True))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Rows of sets with 100 |both| >= 80 |either| are linked; a component's id is its least doc_id, whose row is kept.
    Null and empty texts and texts without words have no shingles and link with nothing. Rows that share a doc_id are
    one node; a row with a null doc_id has a null component and is kept. Repeated rows each give a row.
    """
    rows = narrow(docs, id=id_col, text=text_col)
    sketches = stored(_sketches(rows, words), "sketches")
    known = sketches.where("n > 0 AND id IS NOT NULL")
    classes = stored(known.groupBy("hi", "lo").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")
    members = _members(classes)
    texts = stored(rows.join(members.select("id").distinct(), "id", "left_semi"), "texts")
    links = _links(members, texts, words)

    sets = known.select("id", "n", "hi", "lo")
    repeated = stored(sketches.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id"), "repeated")
    several = not repeated.isEmpty()
    if several:  # the sets of an id are linked through it
        owned = sets.join(repeated, "id").join(classes.select("hi", "lo", F.col("id").alias("owner")), ["hi", "lo"])
        links = links.union(owned.where("id != owner").select("id", "owner"))
    found = connected_components(links)
    of_class = classes.select("hi", "lo", F.col("id").alias("node")).join(found, "node", "left").select("hi", "lo", F.coalesce("component", "node").alias("component_id"))
    placed = sets.join(stored(of_class, "of_class"), ["hi", "lo"]).select("id", "n", "component_id")
    placed = placed.union(sketches.where("n = 0 OR id IS NULL").select("id", "n", F.col("id")))
    if several:
        of_id = found.toDF("id", "of_id").join(repeated, "id", "left_semi")
        placed = placed.join(of_id, "id", "left").select("id", "n", F.least("component_id", "of_id").alias("component_id"))
    return placed.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns, without the near-duplicates of a lesser id; of rows that share an id one stays,
    the least by its columns' order."""
    groups = near_duplicates(docs, id_col, text_col, words)
    goes = groups.where("NOT kept").select(F.col("doc_id").alias(id_col)).distinct()
    stays = docs.join(goes, id_col, "left_anti").select(docs.columns)
    if not groups.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        stays = stays.where(F.col(id_col).isNull()).union(stays.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(F.struct(docs.columns)).alias("row")).select("row.*"))
    return stays
