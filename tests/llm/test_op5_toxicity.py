from tallyhouse.llm import op5_toxicity
from tallyhouse.llm.op5_toxicity import crc_fold, op5_boosted_toxicity, plain, score
from tallyhouse.llm.tables import read


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in read(spark, folder, "labels").collect()}
    rows = op5_boosted_toxicity(spark, folder).collect()
    assert all(r.held_out == (crc_fold(r.doc_id) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    test = [(r.score, r.predicted, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    pos, neg = [s for s, _, t in test if t], [s for s, _, t in test if not t]
    auc = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
    assert auc > 0.97, auc
    assert sum(p == t for _, p, t in test) / len(test) > 0.95


def test_few_or_no_labels_nulls_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None), (None, "you idiot"), (2, ""), (3, "fine")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in score(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(3, 1), (None, 0)], "doc_id long, toxic int")
    assert {r.score for r in score(docs, one).collect()} == {1.0}
    two = spark.createDataFrame([(3, 1), (2, 0), (2, 0), (1, None)], "doc_id long, toxic int")
    assert len(score(docs, two).collect()) == 4
    assert score(docs.limit(0), two).count() == 0


def test_disguised_words_are_spelled_out():
    assert plain("1d10t") == ("1d10t", False) or plain("1d10t")[0] == "idiot"
    assert plain("id1ot!") == ("idiot", True)
    assert plain("i.d.i.o.t") == ("idiot", True)
    assert plain("word,") == ("word", False)


def test_scores_are_shares_of_all_labels_when_the_sample_is_full(spark, monkeypatch):
    """A quarter of the loud documents are toxic; a sample of equal classes would see nine in ten."""
    monkeypatch.setattr(op5_toxicity, "SAMPLE", 200)
    kinds = ["loud toxic"] * 300 + ["loud clean"] * 900 + ["calm clean"] * 4800
    docs = spark.createDataFrame([(i, "well then " + ("!!! " * 9 if k[0] == "l" else "so ")) for i, k in enumerate(kinds)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k.endswith("toxic"))) for i, k in enumerate(kinds)], "doc_id long, toxic int")
    rows = score(docs, labels).collect()
    loud = {r.score for r in rows if r.doc_id < 1200}
    assert all(0.15 < s < 0.4 for s in loud), loud
    assert not any(r.predicted for r in rows)
