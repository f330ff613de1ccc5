import json
import shutil

import pandas as pd
from pyspark.sql import functions as F

from catalith.operators import review as rv
from catalith.streaming import incremental as ic
from catalith.streaming import live


def doc(name, *fields):
    return json.dumps({"portal_id": "p", "dataset_key": name, "evidence_id": "e", "source_url": "u",
                       "fields": [{"name": f} for f in fields]})


def test_incremental_index_replaces_changed_documents(spark, tmp_path):
    src, log, cp = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "cp")
    src.mkdir()
    (src / "a@1").write_text(doc("a", "x", "y"))
    (src / "b@1").write_text(doc("b", "z"))
    ic.incremental_index(ic.definition_stream(spark, str(src)), log, cp).awaitTermination(120)
    fields, errors = ic.current_definitions(ic.read_log(spark, log))
    assert sorted((r.path, r.name) for r in fields.collect()) == [("a", "x"), ("a", "y"), ("b", "z")]
    (src / "a@2").write_text(doc("a", "new"))
    (src / "c@1").write_text("{oops")
    ic.incremental_index(ic.definition_stream(spark, str(src)), log, cp).awaitTermination(120)
    fields, errors = ic.current_definitions(ic.read_log(spark, log))
    assert sorted((r.path, r.name) for r in fields.collect()) == [("a", "new"), ("b", "z")]
    assert [(r.path, r.error) for r in errors.collect()] == [("c", "invalid_json")]
    # Nothing new: the checkpoint remembers what was read.
    ic.incremental_index(ic.definition_stream(spark, str(src)), log, cp).awaitTermination(120)
    assert ic.read_log(spark, log).count() == 4


def test_upsert_stream_and_retry(spark, tmp_path):
    src, log = str(tmp_path / "in"), str(tmp_path / "log")
    schema = "id string, title string, seq long"
    spark.createDataFrame([("1", "a", 1), ("2", "b", 2)], schema).write.parquet(src)
    stream = lambda: spark.readStream.schema(schema).parquet(src)
    ic.append_batches(stream(), log, str(tmp_path / "cp")).awaitTermination(120)
    # The same batch again (a restart without its checkpoint) replaces its own folder.
    ic.append_batches(stream(), log, str(tmp_path / "cp2")).awaitTermination(120)
    assert ic.read_log(spark, log).count() == 2
    spark.createDataFrame([("2", "b2", 3), ("3", "c", 4)], schema).write.mode("append").parquet(src)
    ic.append_batches(stream(), log, str(tmp_path / "cp")).awaitTermination(120)
    view = {r.id: (r.title, r.versions) for r in ic.upsert_view(ic.read_log(spark, log), ["id"], ["batch", "seq"]).collect()}
    assert view == {"1": ("a", 1), "2": ("b2", 2), "3": ("c", 1)}
    flags = {r.id: r.kept_as_history for r in ic.history_flags(ic.read_log(spark, log), ["id"], "batch").collect()}
    assert flags == {"1": True, "2": False, "3": False}
    shutil.rmtree(src)


def memory(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def events(spark, tmp_path, rows, schema):
    path = str(tmp_path / "ev")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def test_progress_streams(spark, tmp_path):
    rows = [("q", "ok", "2024-01-01 00:10:00"), ("q", "ok", "2024-01-01 05:00:00"), ("q", "bad", "2024-01-02 01:00:00")]
    schema = "queue string, status string, ts string"
    s = events(spark, tmp_path, rows, schema)
    out = memory(live.queue_progress_stream(s), "progress", "complete")
    assert {(r.status, r.processed) for r in out.collect()} == {("ok", 2), ("bad", 1)}
    w = memory(live.windowed_progress(s.withColumn("ts", F.to_timestamp("ts")), "ts", "status"), "windows", "append")
    # The watermark has passed the end of the first day only.
    assert [(r.status, r.n) for r in w.collect()] == [("ok", 2)]
    d = memory(live.dedupe_cache(s.withColumn("ts", F.to_timestamp("ts")), "ts", "queue"), "cache", "append")
    assert d.count() == 1


def test_review_stream_equals_batch(spark, tmp_path):
    seq = ["under_review", "approved", "rejected", "stale", "under_review", "needs_revision", "superseded", "approved"]
    rows = [(p, i, seq[(i * step) % len(seq)]) for p, step in (("a", 1), ("b", 3)) for i in range(20)]
    schema = "proposal_id string, seq long, to_state string"
    s = events(spark, tmp_path, rows, schema)
    live_rows = memory(live.review_state_stream(s), "review", "append").toPandas()
    batch = rv.apply_review_events(spark.createDataFrame(rows, schema), "proposal_id", ["seq"], "to_state").toPandas()
    key = ["proposal_id", "seq"]
    a = live_rows.sort_values(key).reset_index(drop=True)[[*key, "state_before", "state_after", "accepted"]]
    b = batch.sort_values(key).reset_index(drop=True)[[*key, "state_before", "state_after", "accepted"]]
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_retention(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-25",)], "d string").withColumn("ts", F.to_timestamp("d"))
    assert [r.d for r in ic.retain(df, "ts", 10, "2024-01-31 00:00:00").collect()] == ["2024-01-25"]
