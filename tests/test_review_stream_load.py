import inspect

import pandas as pd
from pyspark.sql import functions as F

from catalith.plans import files
from catalith.streaming import live


class State:
    exists, hasTimedOut = False, False

    def update(self, value):
        self.value = value


def test_a_proposal_of_one_frame_needs_no_frame_sort(spark, monkeypatch):
    """Joining and sorting frames took most of a proposal's time."""
    held = {}
    events = spark.createDataFrame([(1, 1, "approved")], "proposal_id long, seq long, to_state string")
    kind = type(events.groupBy("proposal_id"))

    def keep(self, fn, schema, *rest):
        held["run"] = fn
        return spark.createDataFrame([], schema)

    monkeypatch.setattr(kind, "applyInPandasWithState", keep)
    live.review_state_stream(events)
    states = ["under_review", "approved", "stale", None, "no such state"]
    frame = pd.DataFrame({"proposal_id": 1, "seq": range(33, 0, -1), "to_state": [states[i % 5] for i in range(33)]})
    monkeypatch.setattr(pd, "concat", None)
    monkeypatch.setattr(pd.DataFrame, "sort_values", None)
    state = State()
    out = list(held["run"]((1,), iter([frame]), state))
    assert out[0]["seq"].tolist() == list(range(1, 34)) and state.value[1] == 33


def test_arrivals_need_no_exact_median():
    assert "percentile_disc" not in inspect.getsource(files._arrivals)


def test_numbers_beyond_a_frame_and_nulls(spark, tmp_path):
    rows = [("a", None, "approved"), ("a", 2, "approved"), ("a", 1, "under_review"), ("a", 2, "rejected"), ("b", None, None)]
    schema = "proposal_id string, seq long, to_state string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    q = live.review_state_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName(
        "nulls").outputMode("append").trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    got = spark.table("nulls").select("proposal_id", "seq", "to_state", "state_before", "state_after", "accepted", "late").orderBy(
        "proposal_id", F.col("seq").asc_nulls_last(), "late").collect()
    assert [tuple(r) for r in got] == [
        ("a", 1, "under_review", "proposed", "under_review", True, False), ("a", 2, "approved", "under_review", "approved", True, False),
        ("a", 2, "rejected", "approved", "approved", False, True), ("a", None, "approved", "approved", "approved", False, True),
        ("b", None, None, "proposed", "proposed", False, True)]
