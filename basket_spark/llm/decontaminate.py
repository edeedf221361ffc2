"""Benchmark decontamination: BM25 over the test items with block-max WAND, then question and answer overlap.

Every training text is read as overlapping passages, twice as long as the longest item, so that each run of an item's
length lies whole in one of them. A passage is a query against the inverted index of the items; all items whose score
reaches ``threshold`` of the score they give themselves are retrieved. A hit counts when the passage holds most
five-word runs of the item's question part and of its answer part (its last sentence). An item of fewer than five words
has no such parts: it is retrieved in the same way and hit where all its words stand in a row. If its words are
together less rare than ``RARE`` words that a single item has ("yes", "all of them"), it says nothing about where a text
comes from, and only a text of just these words is hit.

Document frequencies and lengths are those of all items, whatever parts the index is cut into for the executors: scores
don't depend on the parts.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, narrow, stored, utf8

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
RARE = 2.0
#: The index goes to the executors in parts of about so many characters of item text, one after the other.
INDEX_CHARS = 8_000_000
FINE_CELLS = 20_000_000
#: So many words of a text, and bytes, are worked on at a time.
WINDOW, SEGMENT = 1 << 16, 1 << 20
#: ASCII other than digits and letters splits words; A-Z is lower-cased first.
_SPLIT = bytes(i if chr(i).isalnum() and i < 128 or i > 127 else 32 for i in range(256))
_END = re.compile(rb"(?<=[.!?])\s+")


def words(text: bytes | None) -> list[bytes]:
    return text.lower().translate(_SPLIT).split() if text else []


def runs(found: list[int], size: int) -> set[tuple[int, ...]]:
    n = min(size, len(found))
    return {tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if n else set()


def answer_start(text: bytes) -> int:
    """How many words of an item are its question: all but those of its last sentence. With one sentence the last quarter
    of the words is the answer."""
    sentences = [n for s in _END.split(text) if (n := len(words(s)))]
    if len(sentences) > 1:
        return sum(sentences[:-1])
    return sentences[0] - max(1, sentences[0] // 4) if sentences else 0


class Index:
    """Inverted index of items with block maxima; contributions are shares of an item's own score.

    ``items``: (id, text, weights), weights as (word, contribution). Terms are the words in order; the postings of term t
    are ``places`` and ``values`` from ``first[t]`` to ``first[t + 1]``, items ascending. Items lie in blocks of ``block``;
    ``maxima[term, block]`` bounds a term's contribution there, its last row is for unknown words. ``longest`` is the
    length of the longest of all items, in this part or not. ``quiet`` are the places of short items whose words say too
    little: they aren't in the index but in ``short``, by their words.
    """

    def __init__(self, items: list[tuple[object, bytes, list[tuple[bytes, float]]]], longest: int, block: int | None = None, quiet: frozenset[int] = frozenset()) -> None:
        self.longest = max(1, longest)
        self.short: dict[tuple[bytes, ...], list[object]] = {}
        for i in sorted(quiet):
            self.short.setdefault(tuple(words(items[i][1])), []).append(items[i][0])
        items = [x for i, x in enumerate(items) if i not in quiet]
        self.ids = [k for k, _, _ in items]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for _, _, weights in items for w, _ in weights}))}
        n_terms, n = len(self.vocabulary), len(items)
        term = np.array([self.vocabulary[w] for _, _, weights in items for w, _ in weights], np.int64)
        item = np.repeat(np.arange(n), [len(weights) for _, _, weights in items])
        value = np.array([v for _, _, weights in items for _, v in weights], np.float64)
        order = np.lexsort((item, term))
        term, item, value = term[order], item[order], value[order]
        self.places, self.values = array("q", item.tobytes()), array("d", value.tobytes())
        self.first = array("q", np.searchsorted(term, np.arange(n_terms + 1)).tobytes())
        self.block = block or max(4, -(-n // 64))
        # Maxima of smaller blocks, as far as a fixed size allows: they rule out most of what the larger ones let pass.
        self.small = max(1, self.block // 4, -(-n * (n_terms + 1) // FINE_CELLS))
        self.maxima, self.fine = (self._maxima(term, item // size, value, n_terms, max(1, -(-n // size))) for size in (self.block, self.small))
        self.sequences = [array("i", (self.vocabulary[w] for w in words(text))) for _, text, _ in items]
        self.answers = [answer_start(text) for _, text, _ in items]

    @staticmethod
    def _maxima(term: np.ndarray, block: np.ndarray, value: np.ndarray, n_terms: int, n_blocks: int) -> np.ndarray:
        out = np.zeros((n_terms + 1, n_blocks), np.float32)
        np.maximum.at(out, (term, block), value.astype(np.float32))
        return out

    def sides(self, item: int) -> tuple[list[int], list[int]]:
        """Terms of the item's question and of its answer; of a short item both are the whole."""
        found = self.sequences[item].tolist()
        if len(found) < SHINGLE:
            return found, found
        return found[: self.answers[item]] or found, found[self.answers[item] :]

    def wand(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items whose contributions over the distinct ``terms`` sum to the threshold, with that sum.

        Terms stand at their current item; the pivot is the first item that the terms' upper bounds let reach the
        threshold. If the maxima of its block don't, all terms move past the block (or the next term's item).
        """
        low, out = threshold - 1e-6, []
        places, values, maxima = self.places, self.values, self.maxima
        at = [[places[self.first[t]], t, self.first[t], self.first[t + 1], float(maxima[t].max())] for t in sorted(set(terms))]
        while at:
            at.sort()
            bound, pivot = 0.0, -1
            for k, x in enumerate(at):
                bound += x[4]
                if bound >= low:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = at[pivot][0]
            while pivot + 1 < len(at) and at[pivot + 1][0] == item:
                pivot += 1
            block = item // self.block
            if sum(float(maxima[x[1], block]) for x in at[: pivot + 1]) >= low:
                if at[0][0] == item:
                    score = sum(values[x[2]] for x in at[: pivot + 1])
                    if score >= low:
                        out.append((item, score))
                    target = item + 1
                else:
                    target = item
            else:
                target = (block + 1) * self.block
                if pivot + 1 < len(at):
                    target = max(item + 1, min(target, at[pivot + 1][0]))
            for x in at[: pivot + 1]:
                while x[2] < x[3] and places[x[2]] < target:
                    x[2] += 1
                x[0] = places[x[2]] if x[2] < x[3] else -1
            at = [x for x in at if x[0] >= 0]
        return out

    def terms(self, text: bytes) -> np.ndarray:
        """The terms of a text's words; unknown words have the number after the last term."""
        low, get, unknown = text.lower().translate(_SPLIT), self.vocabulary.get, len(self.vocabulary)
        out, at = [np.zeros(0, np.int32)], 0
        while at < len(low):
            end = low.find(b" ", at + SEGMENT)
            end = end if end >= 0 else len(low)
            out.append(np.array([get(w, unknown) for w in low[at:end].split()], np.int32))
            at = end
        return np.concatenate(out)

    def likely(self, terms: np.ndarray, low: float) -> Iterator[tuple[int, int]]:
        """(start, end) of the passages whose terms' block maxima sum to ``low`` in some block.

        Passages are twice as long as the longest item and half overlap; each half is summed once, ``WINDOW`` words at a
        time, so what is held doesn't grow with the text.
        """
        n, half = len(terms), self.longest
        step, last = max(half, WINDOW // half * half), None
        for start in range(0, n, step):
            part = terms[start : start + step]
            if half <= WINDOW:
                sums = np.add.reduceat(self.maxima[part], np.arange(0, len(part), half), axis=0, dtype=np.float64)
            else:
                sums = sum(self.maxima[part[i : i + WINDOW]].sum(0, dtype=np.float64) for i in range(0, len(part), WINDOW))[None]
            before = sums if last is None else np.concatenate((last, sums))
            both = before[:-1] + before[1:] if n > half else before
            base = start - half * (last is not None)
            for p in np.flatnonzero(both.max(1) >= low) if len(both) else ():
                yield base + int(p) * half, min(n, base + (int(p) + 2) * half)
            last = sums[-1:]

    def hits(self, text: bytes | None, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[tuple[object, float, float, float]]:
        """(item id, score, question overlap, answer overlap) of the verified items, the best passage of each."""
        if not text:
            return []
        terms, unknown = self.terms(text), len(self.vocabulary)
        just = self.short.get(tuple(words(text)), ()) if self.short and len(terms) < SHINGLE else ()
        best: dict[int, tuple[float, float, float]] = {}
        low = threshold - 1e-4
        for a, b in self.likely(terms, low) if self.ids and len(terms) else ():
            distinct = np.unique(terms[a:b])
            distinct = distinct[distinct < unknown]
            if self.maxima[distinct].sum(0).max() < low or self.fine[distinct].sum(0).max() < low:
                continue
            own = None
            for item, score in self.wand(distinct.tolist(), threshold):
                own = own if own is not None else terms[a:b].tolist()
                share = []
                for side in self.sides(item):
                    wanted, there = runs(side, SHINGLE), runs(own, min(SHINGLE, len(side)))
                    share.append(sum(g in there for g in wanted) / len(wanted))
                if min(share) >= overlap:
                    best[item] = max(best.get(item, (0.0, 0.0, 0.0)), (score, *share))
        return [(k, 1.0, 1.0, 1.0) for k in just] + [(self.ids[i], *v) for i, v in sorted(best.items())]


def weighted(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """(item, id, text, weights, quiet) of the items that have words, and the length of the longest in words.

    ``weights`` are a word's share of the item's BM25 score of itself, by the document frequencies and the mean length of
    all items; ``quiet`` are short items whose words are together less rare than ``RARE`` words of a single item. Three numbers come to the driver; the rest is written to the shared folder.
    """
    rows = stored(narrow(items, id=id_col, text=text_col).where(F.length("text") > 0).select(F.monotonically_increasing_id().alias("item"), "id", "text"), "items")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            found = [(k, w, n, len(own)) for k, t in zip(batch["item"].to_pylist(), utf8(batch["text"]), strict=True) if (own := words(t)) for w, n in Counter(own).items()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), (pa.int64(), pa.binary(), pa.int64(), pa.int64()), strict=True)], ["item", "word", "tf", "length"])

    counts = stored(rows.mapInArrow(count, "item long, word binary, tf long, length long"), "words")
    n, mean, longest = counts.groupBy("item").agg(F.first("length").alias("length")).agg(F.count("*"), F.avg("length"), F.max("length")).first()
    frequency = stored(counts.groupBy("word").agg(F.count("*").alias("df")), "frequencies")
    rare = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    often = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / (mean or 1.0)))
    rarest = math.log(1 + (n - 0.5) / 1.5) or 1.0
    each = counts.join(frequency, "word").groupBy("item").agg(F.array_sort(F.collect_list(F.struct("word", (rare * often).alias("w")))).alias("weights"), ((F.sum(rare) / rarest < RARE - 1e-9) & (F.first("length") < SHINGLE)).alias("quiet"))
    total = F.aggregate("weights", F.lit(0.0), lambda s, x: s + x["w"])
    each = each.withColumn("total", total).select("item", F.transform("weights", lambda x: F.struct(x["word"].alias("word"), (x["w"] / F.col("total")).alias("w"))).alias("weights"), "quiet")
    return stored(rows.join(each, "item"), "weighted"), longest or 0


def indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text", chars: int = INDEX_CHARS) -> tuple[int, Iterator[Index]]:
    """How many parts the index has, and the parts, built one by one as they are asked for.

    A part has about ``chars`` characters of text (an item at least), so the driver holds no more. Null and empty items are
    left out.
    """
    rows, longest = weighted(items, id_col, text_col)
    n = max(1, -(-(rows.agg(F.sum(F.length("text"))).first()[0] or 0) // chars))

    def build() -> Iterator[Index]:
        for k in range(n):
            got = (rows if n == 1 else rows.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k)).orderBy("item").toArrow()
            lists = [[(x["word"], x["w"]) for x in each] for each in got["weights"].to_pylist()]
            quiet = frozenset(i for i, q in enumerate(got["quiet"].to_pylist()) if q)
            yield Index(list(zip(got["id"].to_pylist(), utf8(got["text"]), lists, strict=True)), longest, quiet=quiet)

    return n, build()


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP, chars: int = INDEX_CHARS) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): each item that a document holds, its best passage.

    Documents without text and empty tables give no row. Repeated documents each give their rows, and so do repeated
    items. A null id stays null. Where the items need several parts, the documents are read once for each, and the part
    before is dropped from the executors.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    kind, kind2 = rows.schema["doc_id"].dataType.simpleString(), narrow(items, id=item_id).schema["id"].dataType.simpleString()
    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
    found = None
    n, parts = indexes(items, item_id, item_text, chars)
    for index in parts:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for batch in few(batches):
                out = [(doc, *h) for doc, text in zip(batch["doc_id"].to_pylist(), utf8(batch["text"]), strict=True) for h in shared.value.hits(text, threshold, overlap)]
                if out:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out, strict=True)), strict=True)))

        hits = rows.mapInArrow(run, f"doc_id {kind}, item_id {kind2}, score double, question_overlap double, answer_overlap double")
        if n > 1:
            hits = stored(hits, "hits")
            shared.unpersist()
        found = hits if found is None else found.union(hits)
    return found


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", chars: int = INDEX_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item."""
    at = docs.columns.index(text_col)
    n, parts = indexes(items, chars=chars)
    for index in parts:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for batch in few(batches):
                yield batch.filter(pa.array([not shared.value.hits(t) for t in utf8(batch.column(at))], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if n > 1:
            docs = stored(docs, "clean")
            shared.unpersist()
    return docs
