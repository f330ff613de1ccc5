"""op5 packs a small table in its scan order."""

import pytest

pytest.importorskip("public_tokenizers")

from catalith.llm import packing, registry  # noqa: E402


def test_small_table_keeps_scan_order(spark, tmp_path):
    registry.on_workers(spark)
    rows = [((i * 37) % 101, f"Text {i} of a few words.") for i in range(101)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = packing.op5(spark, str(tmp_path)).filter("start = 0").orderBy("sequence_id", "offset").collect()
    assert [r["doc_id"] for r in got] == [k for k, _ in rows]
