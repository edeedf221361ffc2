"""Token counts of texts under a sentencepiece BPE model, from counts of distinct pre-tokens.

A pre-token is what no piece reaches across: a run of blanks with the word after it, or a line feed. Each distinct
pre-token of the table is encoded once; the counts are joined to the documents' pre-token frequencies and summed. The
most frequent pre-tokens, a bounded number, are looked up where the documents are read; the others go through a join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, narrow, stored

#: At most so many of the most frequent pre-tokens are broadcast, none of them longer than so many bytes (so 17 MB of text at most).
HEAD = 1 << 18
HEAD_BYTES = 64
OVER = 4096
#: Rows that are taken apart at a time.
ROWS = 2048
_MARK = "▁"
_BREAK = "\x1f"
_SLOW = f"^ |  |{_MARK}|{_BREAK}"
_PRETOKEN = re.compile(r" +[^ \n]*|\n|[^ \n]+")


def _model(path: str):  # noqa: ANN202
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_model(path: str) -> None:
    """Raise unless the pre-tokens above are right for the model: BPE that doesn't alter texts but for a blank put in
    front, no piece with a line feed or with a blank after something else, no piece that is matched before merging."""
    sp = _model(path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not sp.is_control(i) and not sp.is_unknown(i)]
    if any("\n" in p or re.search(f"[^{_MARK}]{_MARK}", p) for p in pieces):
        raise ValueError("a piece of the model reaches across pre-tokens")
    probe = " Åﬁ  x½　\ta<s>­ \n"
    if sp.decode(sp.encode(probe)) != probe or sp.encode(probe) == sp.encode(probe.strip()):
        raise ValueError("the model alters texts")


def _tokens(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All pre-tokens of the column's texts in order, and the row of each. A blank goes in front of each text."""
    column = column.take(pa.array(np.arange(len(column))))  # some of Arrow's string functions misread slices
    slow = pc.fill_null(pc.match_substring_regex(column, _SLOW), False)
    plain = pc.if_else(slow, pa.scalar(None, column.type), pc.if_else(pc.equal(column, ""), pa.scalar(None, column.type), column))
    broken = pc.replace_substring(pc.replace_substring(plain, " ", f"{_BREAK} "), "\n", f"{_BREAK}\n{_BREAK}")
    lists = pc.split_pattern(pc.binary_join_element_wise(pa.scalar(" ", column.type), broken, pa.scalar("", column.type)), _BREAK)
    tokens, rows = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    full = pc.not_equal(tokens, "")
    tokens, rows = tokens.filter(full), rows[full.to_numpy(zero_copy_only=False)]
    at = np.flatnonzero(slow.to_numpy(zero_copy_only=False))
    if len(at):
        found = [_PRETOKEN.findall(" " + column[int(i)].as_py().replace(_MARK, " ")) for i in at]
        tokens = pa.concat_arrays([tokens, pa.array([t for f in found for t in f], tokens.type)])
        rows = np.concatenate((rows, np.repeat(at, [len(f) for f in found])))
    return tokens, rows


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in few(batches, ROWS):
        found = pc.value_counts(_tokens(batch["text"])[0])
        yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts").cast(pa.int64())], ["token", "n"])


def _cut(counts: DataFrame, most: int) -> int:
    """A frequency that at most ``most`` rows of ``counts`` reach, the least such one to eight binary digits.

    Only a histogram comes to the driver: a row for each frequency below 256, and 128 for each power of two above.
    """
    step = F.pow(F.lit(2), F.greatest(F.length(F.bin("n")) - 8, F.lit(0))).cast("long")
    bins = counts.select((F.col("n") - F.col("n") % step).alias("low")).groupBy("low").count().orderBy(F.desc("low")).collect()
    cut, so_far = 1 << 62, 0
    for low, n in bins:
        so_far += n
        if so_far > most:
            break
        cut = low
    return cut


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row: what the library gives for the whole text, without begin
    and end. Null texts are empty and have none. Repeated rows and null ids each give a row."""
    check_model(model_path)
    spark = docs.sparkSession
    rows = narrow(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _model(model_path)
        for batch in batches:
            # The model puts a blank in front of whatever it gets. What has no blank of its own goes behind a line feed,
            # as in the texts: no piece reaches across it, while one may join another letter with what follows.
            texts = batch["token"].to_pylist()
            counts = [len(x) for x in sp.encode([t[1:] if t[0] == " " and t[1:] else "x\n" + t for t in texts], num_threads=1)]
            alone = len(sp.encode("x\n"))
            counts = [n if t[0] == " " and t[1:] else n - alone for n, t in zip(counts, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["token"], batch["n"], pa.array(counts, pa.int64())], ["token", "n", "pieces"])

    distinct = rows.select("text").mapInArrow(_distinct, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    known = stored(distinct.mapInArrow(pieces, "token string, n long, pieces long"), "pieces")
    short = known.where(F.octet_length("token") <= HEAD_BYTES)
    top = short.where(F.col("n") >= _cut(short, head)).select("token", "pieces").toArrow()
    shared = spark.sparkContext.broadcast((top["token"].combine_chunks(), top["pieces"].to_numpy()))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, pieces_of = shared.value
        for batch in few(batches, ROWS):
            n_rows = batch.num_rows
            tokens, row = _tokens(batch["text"])
            coded = tokens.dictionary_encode()
            words, code = coded.dictionary, coded.indices.to_numpy()
            place = pc.fill_null(pc.index_in(words, frequent), -1).to_numpy() if len(words) else np.zeros(0, int)
            own = np.where(place >= 0, pieces_of[place] if len(pieces_of) else 0, 0)
            sums = np.bincount(row, own[code], n_rows).astype(np.int64) if len(code) else np.zeros(n_rows, np.int64)
            rare = place[code] < 0
            keys, freq = np.unique(row[rare].astype(np.int64) * len(words) + code[rare], return_counts=True)
            of, word = (keys // len(words), keys % len(words)) if len(keys) else (keys, keys)
            none = np.setdiff1d(np.arange(n_rows), of)
            # A row without rare pre-tokens goes along under a key that no pre-token is.
            token = pa.concat_arrays([words.take(pa.array(word)), pa.array([f"x {k}" for k in batch["row"].take(pa.array(none)).to_pylist()], words.type)])
            of, first = np.concatenate((of, none)), np.zeros(len(of) + len(none), np.int64)
            once, start = np.unique(of, return_index=True)
            first[start] = sums[once]
            take = pa.array(of)
            yield pa.RecordBatch.from_arrays([batch["row"].take(take), batch["doc_id"].take(take), batch["n_bytes"].take(take), token.cast(pa.string()), pa.array(np.concatenate((freq, np.zeros(len(none), np.int64)))), pa.array(first)], ["row", "doc_id", "n_bytes", "token", "freq", "head"])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    found = numbered.mapInArrow(measure, f"row long, doc_id {kind}, n_bytes long, token string, freq long, head long")
    total = found.join(known.select("token", "pieces"), "token", "left").groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.sum(F.col("head") + F.col("freq") * F.coalesce("pieces", F.lit(0))).alias("n_tokens"))
    return total.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > OVER).alias("over_limit"))
