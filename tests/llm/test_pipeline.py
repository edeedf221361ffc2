import re

import corpus_pipeline
import public_tokenizers
import tiktoken
from basket_spark.llm import byte_bpe, decontaminate, lang_id, pii

from .test_decontaminate import brute as brute_items
from .test_lang_id import plain_predictor
from .test_minhash import brute as brute_groups

DIR = "/root/testdata/sf0.001"


def test_against_brute_force(spark, real):
    """The stages by plain loops: letters, groups of all pairs, all passages against all items, surrogates, the library's
    ids. Language by the plain predictor for the short texts; none of them is so mixed that it goes."""
    rows = [(r.doc_id, r.text) for r in real.collect()]
    rows = [(k, t) for k, t in rows if t and any(map(str.isalpha, t))]
    predict = plain_predictor(real)
    assert all(predict(t)[1] > 0.5 + lang_id.REJECT_GAP for _, t in rows if len(t) <= 1000)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, real, DIR).select("doc_id").collect()}
    assert kept == {k for k, _ in rows}
    groups = brute_groups(rows, 5)
    rows = [(k, t) for k, t in rows if groups[k][1] == k]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    leaks = {k for k, _ in brute_items(rows, items)}
    surrogates = pii.Surrogates(pii.session_key(spark))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = {k: library.encode_ordinary(surrogates.apply(t)[0]) for k, t in rows if k not in leaks}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, DIR).collect()}
    assert {k: [int.from_bytes(r.ids[i : i + 4], "little") for i in range(0, len(r.ids), 4)] for k, r in got.items()} == want
    assert all(r.n_tokens == len(want[k]) for k, r in got.items())
    assert len(got) > 100


def test_stages_return_the_columns_of_documents(spark, real, odd, none):
    for docs in (real.limit(20), odd.select(real.columns), none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, DIR).columns == real.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, DIR).count() == docs.count()


def test_stage_names():
    assert len(corpus_pipeline.STAGES) == 5
    assert all(re.fullmatch(r"\w+", n) for n, _ in corpus_pipeline.STAGES)
    assert decontaminate.SHINGLE == 5
