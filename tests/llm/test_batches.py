"""Arrow batches of the text operators are bounded in bytes, whatever the length of the texts."""

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import minhash, packing, secrets, stats
from ledgerlake.llm import textblocks as tb

CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture()
def at_default(spark):
    old = spark.conf.get(CONF)
    spark.conf.unset(CONF)
    yield
    spark.conf.set(CONF, old)


@pytest.fixture()
def long_texts(spark):
    """2,000 texts of 10 KB in one partition."""
    return spark.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat(concat('word', id % 7, ' '), 1667)").alias("text"))


def largest(rows):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])
    return rows.mapInArrow(run, "n long, size long").agg(F.sum("n"), F.max("size")).first()


@pytest.mark.parametrize("operator", [
    lambda spark, rows: stats.with_counts(rows, "doc_id"),
    lambda spark, rows: minhash.signatures(rows),
    lambda spark, rows: secrets.redact(rows, {}),
    lambda spark, rows: secrets.find(rows, {}, "doc_id"),
    lambda spark, rows: packing.pack(spark, rows.limit(20), public_tokenizers.path("byte_bpe_50k.json")),
])
def test_batches_are_bounded(spark, at_default, long_texts, operator):
    operator(spark, long_texts)
    n, size = largest(long_texts)
    assert n == 2000 and size <= tb.BATCH_BYTES + 100_000


def test_longer_text_than_a_batch(spark, at_default):
    """A text beyond the bound comes whole, between others."""
    texts = ["a b", "c " * (2 * tb.BATCH_BYTES // 2 + 5), None, "", "d"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["n_words"] for r in stats.with_counts(rows, "doc_id").collect()}
    assert got == {0: 2, 1: tb.BATCH_BYTES + 5, 2: 0, 3: 0, 4: 1}


def test_a_lower_bound_is_kept(spark, at_default, long_texts):
    for value in ("64k", "65536", "65536b"):
        spark.conf.set(CONF, value)
        tb.map_batches(long_texts, lambda it: it, long_texts.schema)
        assert spark.conf.get(CONF) == value
    for value in ("64m", "1g"):
        spark.conf.set(CONF, value)
        tb.map_batches(long_texts, lambda it: it, long_texts.schema)
        assert spark.conf.get(CONF) == str(tb.BATCH_BYTES)
