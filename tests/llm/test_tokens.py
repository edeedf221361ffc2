import hashlib

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from basket_spark.llm import byte_bpe, token_count

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.mark.parametrize("head", [1 << 18, 50, 0])
def test_counts_are_the_library_s(odd, real, head):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for docs in (odd, real):
        got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_count.count_tokens(docs, PIECES, head=head).collect()))
        want = []
        for r in docs.collect():
            n = len(sp.encode(r.text or ""))
            want.append((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), n, n > 4096))
        assert got == sorted(want)


def test_odd_spaces_and_symbols(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [" lead", "  lead", "trail ", "trail  ", "a\n", "\n", "\n\n a \n  b", "<s> x </s> <0x0A>", "é ﬁ ²³ ½", "▁▁ x▁y", "a b　c", "\r\n\t", "\x1fa \x1f", "日本語のテキスト", "x\n y", "…  …", "   ", "ab   \n   cd"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_count.count_tokens(docs, PIECES).collect()}
    assert got == {i: len(sp.encode(t)) for i, t in enumerate(texts)}


def test_all_that_follows_a_line_feed(spark):
    """No letter put in front may join what stands at the start of a line: 'xml' is a piece, 'ml' after a line feed another."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").selectExpr("explode(regexp_extract_all(text, '\\\\n([^ \\\\n]+)', 1)) AS t").distinct().collect()
    starts = sorted({"ml", "the.65@mail7.example.com"} | {r.t for r in texts})
    assert len(starts) > 20000
    docs = spark.createDataFrame([(i, f"foo\n{t}") for i, t in enumerate(starts)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_count.count_tokens(docs, PIECES).collect()}
    assert got == {i: len(sp.encode(f"foo\n{t}")) for i, t in enumerate(starts)}


def test_long_pretokens_are_not_broadcast(spark, monkeypatch):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["日本語" * 200, "QUJD" * 500 + " a", "a" * 63 + " " + "b" * 64, "short text"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or send(self, value))
    got = {r.doc_id: r.n_tokens for r in token_count.count_tokens(docs, PIECES).collect()}
    assert got == {i: len(sp.encode(t)) for i, t in enumerate(texts)}
    tokens = [t for value in sent if isinstance(value, tuple) for t in value[0].to_pylist()]
    assert {" short", " text", " a", " " + "a" * 63} == set(tokens)


def test_cut(spark):
    counts = [n for n in range(1, 300) for _ in range(400 // n + 1)] + [1000, 1003, 5000, 123456789]
    frame = spark.createDataFrame([(n,) for n in counts], "n long")
    for most in (0, 1, 2, 3, 10, 200, 1000, len(counts), len(counts) + 1):
        cut = token_count._cut(frame, most)
        assert sum(n >= cut for n in counts) <= most
        assert cut == 1 or cut > 256 or sum(n >= cut - 1 for n in counts) > most


def test_empty(none):
    assert token_count.count_tokens(none, PIECES).count() == 0
    assert byte_bpe.digests(none, RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def test_ids_are_the_library_s(odd, real, reference):
    for docs in (odd, real):
        got = sorted((tuple(r) for r in byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()), key=repr)
        want = []
        for r in docs.collect():
            ids = reference.encode_ordinary(r.text or "")
            want.append((r.doc_id, len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
        assert got == sorted(want, key=repr)


def test_every_token_and_round_trip(reference, odd):
    codec = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    assert all(codec.pieces[rank] == token for token, rank in codec.ranks.items())
    for token in list(codec.ranks)[::7]:
        text = token.decode("utf-8", "ignore")
        assert codec.encode(text) == b"".join(i.to_bytes(4, "little") for i in reference.encode_ordinary(text))
    back = byte_bpe.decoded(byte_bpe.encoded(odd, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert sorted((r.text for r in back.collect())) == sorted((r.text or "") for r in odd.collect())


def test_ranks_must_be_whole():
    with pytest.raises(ValueError, match="every byte"):
        byte_bpe.serialise({b"a": 0, b"b": 2})
