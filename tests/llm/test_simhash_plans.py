"""What grows with the documents is not sent through the driver."""

import pytest

pytest.importorskip("public_tokenizers")

from martwright.llm import simhash_golay  # noqa: E402
from shared import checkpoint_folder  # noqa: E402, F401


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keys_are_not_broadcast_by_the_size_of_their_fingerprints(spark, tmp_path, conf):
    """A fingerprint becomes 67 keys, of which Spark knows nothing."""
    conf("spark.sql.autoBroadcastJoinThreshold", "10m")
    rows = [(i, i << 3 | i % 2) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, print long").write.parquet(f"{tmp_path}/prints")
    found = simhash_golay.links(spark.read.parquet(f"{tmp_path}/prints"))
    assert "SortMergeJoin" in plan_of(found) and "Broadcast" not in plan_of(found)
    assert found.count() > 0 and "Broadcast" not in plan_of(found)


def test_documents_meet_their_component_without_a_broadcast(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "10m")
    rows = [(1, "a b c d"), (2, "A b c d"), (None, "a b c d"), (3, None), (3, "x y z")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    found, kept = simhash_golay.near_duplicates(docs), simhash_golay.keep_first(docs)
    assert "Broadcast" not in plan_of(found) and "Broadcast" not in plan_of(kept)
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(1, 1), (2, 1), (None, 1), (3, 3)}
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(
        map(str, spark.createDataFrame([rows[0], rows[2], *rows[3:]], "doc_id long, text string").collect())
    )
