import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from tallyhouse.llm import op8_sentencepiece as module
from tallyhouse.llm.op8_sentencepiece import MODEL, Transducer, decode, encode, op8_sentencepiece
from tallyhouse.llm.tables import read


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


def test_equals_the_library_and_comes_back(spark, library, odd_texts):
    docs = spark.createDataFrame(list(enumerate(odd_texts)), "doc_id long, text string").repartition(3)
    for r in decode(encode(docs)).collect():
        want = library.encode(odd_texts[r.doc_id])
        assert r.ids == want, odd_texts[r.doc_id]
        assert r.n_ids == len(want)
        assert r.decoded == library.decode(want)
        if "▁" not in r.text:
            assert r.decoded == r.text


def test_nulls_clashes_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (None, "", 6)], "doc_id long, text string, ids int")
    got = decode(encode(docs)).collect()
    assert [(r.ids, r.n_ids, r.decoded) for r in got] == [([], 0, ""), ([], 0, "")]
    assert decode(encode(docs.limit(0))).count() == 0
    rows = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert [r.decoded for r in decode(rows).orderBy("k").collect()] == [None, ""]


def test_any_ids_decode_as_the_library_does(spark, library):
    lists = [[i] for i in range(3, 600)] + [[259, 300, 5], [200, 201, 300], [0xC3 + 3, 0xA9 + 3]]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k int, ids array<int>")
    for r in decode(rows).collect():
        assert r.decoded == library.decode(r.ids), r.ids


def test_query_over_whole_documents(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in read(spark, folder, "documents").collect()}
    got = op8_sentencepiece(spark, folder).collect()
    assert {r.doc_id: r.ids for r in got} == {i: library.encode(t) for i, t in texts.items()}
    assert all(r.lossless for r in got)


def test_one_worker_encodes_and_decodes(spark, library, odd_texts):
    """Ids don't travel to a second worker, which would hold another copy of the model beside the first."""
    folder = "/root/testdata/sf0.001"
    docs = read(spark, folder, "documents")
    for df in (op8_sentencepiece(spark, folder), corpus_pipeline.sentencepiece(spark, docs, folder)):
        assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    odd = spark.createDataFrame([*enumerate(odd_texts), (-1, None)], "doc_id long, text string")
    got = {r.doc_id: (r.ids, r.n_ids, r.decoded) for r in module.encode_and_decode(odd).collect()}
    assert got == {r.doc_id: (r.ids, r.n_ids, r.decoded) for r in decode(encode(odd)).collect()}


def test_small_tables_give_the_same_ids(monkeypatch, library):
    """Parts that are met again come back from the older table; neither grows beyond its bound."""
    monkeypatch.setattr(module, "KEPT", 3)
    monkeypatch.setattr(module, "WINDOWS_KEPT", 2)
    machine = Transducer(public_tokenizers.path(MODEL))
    searched, path = [], machine.path
    monkeypatch.setattr(machine, "path", lambda part: searched.append(part) or path(part), raising=False)
    text = "never more than a few words are kept, never more, internationalisation never"
    for _ in range(2):
        raw = machine.encode(text)
        assert [int.from_bytes(raw[k : k + 4], "little") for k in range(0, len(raw), 4)] == library.encode(text)
        assert len(machine) <= 3 and len(machine.older) <= 3 and len(machine.near) <= 2
    machine.clear()
    machine.older = {"\u2581never": machine["\u2581never"]}
    machine.clear()
    searched.clear()
    assert machine["\u2581never"] == machine.older["\u2581never"] and not searched
