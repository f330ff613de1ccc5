import json
from pathlib import Path

from catalith.durable import scratch_root
from catalith.plans import queries
from catalith.streaming import incremental as ic


def test_bundles_give_what_single_files_give(spark, tmp_path):
    def doc(*fields):
        return json.dumps({"portal_id": "p", "dataset_key": "k\nk", "fields": [{"name": f} for f in fields]})

    arrivals = [{"a@1": doc("x", "y"), "b@1": doc("z"), "d@1": doc()}, {"a@2": doc("new"), "c@1": "{oops"}]
    one, many = tmp_path / "one", tmp_path / "many"
    one.mkdir(), many.mkdir()
    for k, docs in enumerate(arrivals):
        for name, text in docs.items():
            (one / name).write_text(text)
        (many / f"bundle{k}").write_text("\n\n".join(json.dumps({"file": n, "value": v}) for n, v in docs.items()))
        for form, read in ((one, ic.definition_stream), (many, ic.definition_bundle_stream)):
            ic.incremental_index(read(spark, str(form)), f"{form}-log", f"{form}-mark").awaitTermination(120)
    got = [[sorted(map(repr, x.select(*c).collect())) for x, c in zip(ic.current_definitions(ic.read_log(spark, f"{form}-log")), (
        ("path", "portal_id", "dataset_key", "ordinal", "name"), ("path", "error")), strict=True)] for form in (one, many)]
    assert got[0] == got[1] and len(got[0][0]) == 2 and len(got[0][1]) == 1


def test_a_line_that_is_no_document_of_a_bundle_is_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b").write_text('{"file": "a", "value": "{}"}\n{"file": "cut", "va\n{"file": "no text"}\n')
    ic.incremental_index(ic.definition_bundle_stream(spark, str(tmp_path / "in")), str(tmp_path / "log"), str(tmp_path / "m")).awaitTermination(120)
    rows = {r.value: r.name for r in ic.read_log(spark, str(tmp_path / "log")).collect()}
    assert rows.keys() == {"{}", '{"file": "cut", "va', '{"file": "no text"}'} and rows["{}"] == "a"
    assert all(n.startswith("b#") for v, n in rows.items() if v != "{}")


def test_query_writes_no_file_a_supplier(spark, tmp_path):
    """The files a stream lists must not grow with the rows."""
    folder = tmp_path / "t"
    spark.range(400).selectExpr("id s_suppkey", "concat('S', id) s_name", "cast(id % 25 as int) s_nationkey").coalesce(2).write.parquet(str(folder / "supplier.parquet"))
    scratch = Path(scratch_root(spark))
    before = set(scratch.glob("documents-*/part-*"))
    assert queries()["q197_incremental_index"](spark, str(folder)).count() == sum(i % 3 for i in range(400) if i % 5 != 4)
    assert len(set(scratch.glob("documents-*/part-*")) - before) < 50
