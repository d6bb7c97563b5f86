import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm.op1_token_counts import VOCABULARY, op1_token_counts, token_counts
from tallyhouse.llm.tables import read


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def test_equals_the_library(spark, library, odd_texts):
    docs = spark.createDataFrame(list(enumerate(odd_texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_tokens, r.n_bytes) for r in token_counts(docs).collect()}
    for i, e in enumerate(library.encode_batch(odd_texts, add_special_tokens=False)):
        assert got[i] == (len(e.ids), len(odd_texts[i].encode())), odd_texts[i]


def test_nulls_clashes_repeats_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (None, "a b", 6), (1, None, 5)], "doc_id long, text string, n_tokens int")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, limit=1).collect())
    assert got == [("1", 0, 0, False), ("1", 0, 0, False), ("None", 3, 2, True)]
    assert token_counts(docs.limit(0)).count() == 0


def test_query_over_whole_documents(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in read(spark, folder, "documents").collect()}
    want = {i: len(e.ids) for i, e in zip(texts, library.encode_batch(list(texts.values()), add_special_tokens=False), strict=True)}
    got = op1_token_counts(spark, folder).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
