"""What a Python worker is handed at a time in near-dedup."""

from skyledger.llm import near_dedup

DOCS = 1_000


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    """A batch of Spark's usual number of rows holds a whole split of wide texts, on both sides."""
    signatures, confirm, most = near_dedup._signatures, near_dedup._confirm, 256

    def bounded(step):
        def checked(batches):
            for batch in batches:
                assert batch.num_rows <= most, batch.num_rows
                yield batch

        return lambda batches: step(checked(batches))

    monkeypatch.setattr(near_dedup, "_signatures", bounded(signatures))
    monkeypatch.setattr(near_dedup, "_confirm", bounded(confirm))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    # Pairs of texts that differ in their last word.
    docs = spark.range(DOCS, numPartitions=1).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(1, 30), i -> concat(id DIV 2, 'w', i)), concat('x', id)) AS text")
    found, links = near_dedup.near_duplicates(docs)
    assert found.where("component_id = doc_id - doc_id % 2").count() == DOCS
    assert links.count() == DOCS // 2
    assert spark.conf.get(key, None) == before
