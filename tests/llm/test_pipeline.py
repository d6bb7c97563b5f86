import corpus_pipeline
import public_tokenizers
import sentencepiece

from tallyhouse.llm.tables import read
from tests.llm.test_op2_repeats import brute as cut
from tests.llm.test_op6_near_dups import brute as groups

FOLDER = "/root/testdata/sf0.001"


def test_each_stage_on_its_own_input(spark):
    """Every stage against a plain version, on what the stage before kept."""
    stages = dict(corpus_pipeline.STAGES)
    docs = read(spark, FOLDER, "documents")
    columns = docs.columns
    toxic = {r.doc_id for r in read(spark, FOLDER, "labels").where("toxic = 1").collect()}
    clean = {r.doc_id for r in read(spark, FOLDER, "labels").where("toxic = 0").collect()}

    def step(name, docs):
        out = stages[name](spark, docs, FOLDER).cache()
        return out, {r.doc_id: r.text for r in out.collect()}

    before = {r.doc_id: r.text for r in docs.collect()}
    docs, kept = step("toxicity", docs)
    assert docs.columns == columns
    gone = before.keys() - kept.keys()
    assert len(gone & clean) <= 1 and len(toxic & gone) >= 0.8 * len(toxic)

    want = {i for i, _, _, keep in groups(list(kept.items()), size=5) if keep}
    docs, kept2 = step("near_dedup", docs)
    assert kept2.keys() == want and docs.columns == columns

    cuts = {i: (k, t) for i, _, k, t in cut(list(kept2.items()), 13)}
    docs, kept3 = step("substring_dedup", docs)
    assert kept3 == {i: t if k else kept2[i] for i, (k, t) in cuts.items()}

    docs, kept4 = step("mixing", docs)
    rows = docs.groupBy("doc_id").count().collect()
    assert {r["count"] for r in rows} <= {1, 2} and docs.columns == columns
    words = sum(len(t.split()) for t in kept3.values())
    assert 1.4 * words <= sum(len(r.text.split()) for r in docs.collect()) <= 1.5 * words

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = stages["sentencepiece"](spark, docs, FOLDER).collect()
    assert all(r.ids == library.encode(r.text) and r.lossless for r in out)
