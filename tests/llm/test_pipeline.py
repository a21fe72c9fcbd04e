"""The pipeline's stages one after another on a small table."""

import corpus_pipeline
import pytest

from ledgerlake.llm import minhash, mixing, rulefit, secrets
from ledgerlake.llm.queries import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = table(spark, SF, "documents"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def ids(df):
    return {r[0] for r in df.select("doc_id").collect()}


def test_columns_and_shrinking(spark, stages):
    before = table(spark, SF, "documents")
    for s in stages[:-1]:
        assert s.columns == before.columns
        assert ids(s) <= ids(before)
        before = s


def test_decisions(spark, stages):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored = rulefit.train_scores(spark, docs, labels)
    assert ids(stages[0]) == ids(scored.where("predicted = 1"))
    kept = minhash.near_duplicates(spark, stages[0]).where("kept")
    assert ids(stages[1]) == ids(kept)
    model = secrets.learn(spark, stages[1])
    hit = [r for r in secrets.find(stages[1], model, "doc_id").collect() if r["spans"]]
    text = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    assert all(secrets.REDACTED in text[r["doc_id"]] for r in hit) and not any(secrets.base_spans(t)[0] for t in text.values() if t)
    rated = mixing.rates(spark, stages[2], labels, thin=True).collect()
    rate = {r["doc_id"]: r["rate"] for r in rated}
    left = ids(stages[3])
    assert all(i in left for i, r in rate.items() if r >= 1) and all(rate[i] > 0 for i in left)
    # clean documents pass the stage
    clean = [r["doc_id"] for r in rated if r["p_clean"] > 0.9]
    assert len([i for i in clean if i in left]) > 0.97 * len(clean)


def test_packing_covers_what_is_left(stages):
    packed = stages[4].toPandas()
    assert set(packed.doc_id) == ids(stages[3])
    assert (packed.groupby(["doc_id"]).length.sum() == packed.groupby("doc_id").doc_tokens.first()).all()
