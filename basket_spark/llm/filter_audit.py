"""How document filters interact, whatever their order: count-weighted decision diagrams of failure masks.

A document's mask says which of the filters it fails. For each part (a language, say) the documents are counted by mask,
and the counts make a decision diagram: a level for each filter, a pass and a fail edge for each node, counts at the ends,
equal nodes shared, and each node holding the sum of what lies below it. Swapping two adjacent levels rebuilds the nodes
of these levels alone; one swap after the other visits every order of the filters once. Applied in an order, the filters
remove what hangs on the fail edges of the path on which everything passes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, narrow, stored, utf8

FILTERS = "ABCDE"
LEAST_WORDS = 100
#: A long text is taken apart in blocks of about so many bytes.
BLOCK = 1 << 20
_UPPER, _SIGNS, _FOLLOW = bytes(range(65, 91)), b"#$%&*|", bytes(range(0x80, 0xC0))
_BLANKS = b" \t\n\v\f\r"

Counts = tuple[int, ...]  # documents, those of quality 1, toxic ones
_NOTHING: Counts = (0, 0, 0)


class Diagram:
    """A decision diagram over the filters in ``order``; ``order[0]`` is the root's level.

    A node is a number; ``nodes[x]`` is (pass, fail, counts below). Node 0 is the empty diagram of any level. Ends have
    no children (-1). Levels aren't skipped, so a node's sum needs no factor.
    """

    def __init__(self, order: str, masks: dict[int, Counts]):
        """``masks``: counts of each mask; bit i of a mask is set where ``order[i]`` fails."""
        self.order = list(order)
        self.nodes: list[tuple[int, int, Counts]] = [(-1, -1, _NOTHING)]
        self._known: dict[tuple, int] = {}
        self.root = self._build(masks, 0)

    def _node(self, passed: int, failed: int) -> int:
        if not passed and not failed:
            return 0
        sums = tuple(map(sum, zip(self.nodes[passed][2], self.nodes[failed][2], strict=True)))
        return self._shared((passed, failed, sums))

    def _shared(self, node: tuple[int, int, Counts]) -> int:
        if node not in self._known:
            self._known[node] = len(self.nodes)
            self.nodes.append(node)
        return self._known[node]

    def _build(self, masks: dict[int, Counts], level: int) -> int:
        if not masks:
            return 0
        if level == len(self.order):
            (counts,) = masks.values()
            return self._shared((-1, -1, counts))
        sides: tuple[dict[int, Counts], ...] = ({}, {})
        for mask, counts in masks.items():
            sides[mask >> level & 1][mask] = counts
        return self._node(*(self._build(side, level + 1) for side in sides))

    def swap(self, level: int) -> None:
        """Exchange the filters of this level and the next. Nodes above get new children, nodes below stay."""
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        done: dict[int, int] = {0: 0}

        def changed(node: int, depth: int) -> int:
            if node not in done:
                passed, failed, _ = self.nodes[node]
                if depth < level:
                    done[node] = self._node(changed(passed, depth + 1), changed(failed, depth + 1))
                else:
                    (pp, pf, _), (fp, ff, _) = self._children(passed), self._children(failed)
                    done[node] = self._node(self._node(pp, fp), self._node(pf, ff))
            return done[node]

        self.root = changed(self.root, 0)

    def _children(self, node: int) -> tuple[int, int, Counts]:
        return self.nodes[node] if node else (0, 0, _NOTHING)

    def steps(self) -> list[tuple[str, Counts, Counts, Counts]]:
        """(filter, counts that stay, counts removed, counts that fail this filter alone) along the all-pass path."""
        out, node = [], self.root
        for level, name in enumerate(self.order):
            passed, failed, _ = self._children(node)
            alone = failed
            for _ in self.order[level + 1 :]:
                alone = self._children(alone)[0]
            out.append((name, self.nodes[passed][2], self.nodes[failed][2], self.nodes[alone][2]))
            node = passed
        return out


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places i of the swaps of i and i + 1 that lead through all orders of n things, each once (plain changes)."""
    if n < 2:
        return
    inner, down = adjacent_swaps(n - 1), True
    while True:
        yield from reversed(range(n - 1)) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + down  # the last thing stands in front of the others after going down
        down = not down


def audit_part(masks: dict[int, Counts], filters: str = FILTERS) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every order and step."""
    diagram = Diagram(filters, masks)
    fails = {name: sum(c[0] for m, c in masks.items() if m >> i & 1) for i, name in enumerate(filters)}
    total, rows = dict.fromkeys(filters, 0), []
    for swap in chain([None], adjacent_swaps(len(filters))):
        if swap is not None:
            diagram.swap(swap)
        for step, (name, kept, removed, alone) in enumerate(diagram.steps(), 1):
            total[name] += removed[0]
            rows.append((name, "".join(diagram.order), step, kept[0], removed[0], fails[name] - removed[0], alone[0], removed[1], removed[2]))
    return [(*r[1:], total[r[0]]) for r in rows]


def _blocks(text: bytes) -> Iterator[bytes]:
    """The text in blocks that end at blanks, so that no word is cut."""
    start = 0
    while len(text) - start > BLOCK:
        end = start + BLOCK
        while end < len(text) and text[end] not in _BLANKS:
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def text_mask(text: bytes) -> int:
    """Which of the conditions A to D hold for a text in UTF-8, as bits 0 to 3."""
    n_words, distinct, upper, follow, signs = 0, set(), 0, 0, False
    for block in _blocks(text):
        words = block.split()
        n_words += len(words)
        distinct.update(words)
        upper += len(block) - len(block.translate(None, _UPPER))
        follow += len(block) - len(block.translate(None, _FOLLOW))
        signs = signs or len(block.translate(None, _SIGNS)) < len(block)
    fails = (n_words < LEAST_WORDS, 100 * len(distinct) < 80 * n_words, 100 * upper > 10 * (len(text) - follow), signs)
    return sum(f << i for i, f in enumerate(fails))


def _marks(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(doc_id, part, digest of the text, mask of A to D) of each row: the text isn't needed after this."""
    rows = narrow(docs, doc_id=id_col, part=part_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            texts = [t or b"" for t in utf8(batch["text"])]
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["part"], digests, pa.array(map(text_mask, texts), pa.int32())], ["doc_id", "part", "digest", "mask"])

    return rows.select("doc_id", F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"), "text").mapInArrow(run, f"doc_id {kind}, part string, digest binary, mask int")


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the conditions that they fail, those of quality 1 and toxic ones.

    Bits 0 to 4 are A: under 100 words, B: under 80 % distinct words, C: over 10 % capitals, D: a sign of ``#$%&*|``, E: the
    text of a row with a smaller id, in any part. Null texts are empty, null parts the empty string. Rows of the same
    id and text aren't each other's copies; a row without an id is nobody's copy and nobody is its. A document is good or
    toxic if any of its label rows says so. Shuffles carry digests, not texts; rows of a text, an id or a label are
    aggregated before they meet, and what is joined is written first, so that a frequent text is dealt to many tasks.
    """
    marks = _marks(docs, id_col, text_col, part_col).groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    marks = stored(marks, "marks")
    said = narrow(labels, doc_id=id_col, quality="quality", toxic="toxic").where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    is_one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    said = stored(said.agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic")).where("good + toxic > 0"), "labels")
    firsts = marks.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    firsts = stored(firsts.where("first < last").select("digest", "first"), "firsts")
    named = marks.where("doc_id IS NOT NULL").join(firsts, "digest", "left").select("doc_id", "part", "n", (F.col("mask") + F.when(F.col("first") < F.col("doc_id"), 16).otherwise(0)).alias("mask"))
    named = stored(named, "masks").join(said, "doc_id", "left").select("part", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    rows = named.union(marks.where("doc_id IS NULL").select("part", "mask", "n", F.lit(0), F.lit(0)))
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row for every part, order of the filters and step, as in ``mask_counts``; no rows without documents. ``redundant``
    fail the step's filter and are removed earlier, ``unique_fails`` fail it alone, ``shapley`` is what the filter
    removes, summed over all orders. A part is a row of at most 32 counts when its diagram is built.
    """
    counts = mask_counts(docs, labels, id_col, text_col, part_col).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            for part, masks in zip(batch["part"].to_pylist(), batch["masks"].to_pylist(), strict=True):
                rows: Sequence[tuple] = audit_part({m["mask"]: (m["n"], m["good"], m["toxic"]) for m in masks})
                order, step, *numbers = zip(*rows, strict=True)
                arrays = [pa.array([part] * len(rows)), pa.array(order), pa.array(step, pa.int32()), *(pa.array(x, pa.int64()) for x in numbers)]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "filter_order", "step", *names])

    return counts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in names))
