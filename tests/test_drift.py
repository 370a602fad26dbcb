"""Unknown keys at any depth, and CSV files that differ in their headers."""

import json

import pytest
from pyspark.sql import functions as F
from test_layers import RUN, sources, transaction  # noqa: F401 - a fixture
from test_run import account, aside

from tierwright.operators.drift import UnknownColumns, drifted_paths
from tierwright.plans import contracts as C
from tierwright.plans.quality_run import run_with_rules
from tierwright.sinks.tables import LayerStore
from tierwright.sources.files import TRANSACTION_JSON, csv_headers, read_csv_drifting, unknown_csv_columns

LINES = {
    "plain": {},
    "top": {"terminal": "T7"},
    "object": {"extra": {"a": [1, {"b": None}]}},
    "nested": {"location": {"province": "Gauteng", "x": 1.5}},
    "in array": {"location": [{"city": "c"}, {"y": True}]},
    "array of scalars": {"location": ["here"]},
    "arrays in arrays": {"metadata": [[[[{"z": 1}]]]]},
    "no object": {"location": "Gauteng"},
    "null": {"location": None, "metadata": None},
    "empty": {"location": {}, "metadata": []},
    "two": {"terminal": 1, "metadata": {"os": "x", "device_id": "d", "retry_flag": False}},
}
PATHS = {
    "top": {"terminal": "T7"},
    "object": {"extra": {"a": [1, {"b": None}]}},
    "nested": {"location.x": 1.5},
    "in array": {"location[1].y": True},
    "array of scalars": {"location[0]": "here"},
    "no object": {"location": "Gauteng"},
    "two": {"terminal": 1, "metadata.os": "x"},
}


def test_paths_come_from_the_data(spark):
    rows = [(name, json.dumps(transaction(1, "a1", **changes))) for name, changes in LINES.items()]
    rows += [("torn", "{broken"), ("scalar", "12"), ("blank", ""), ("none", None)]
    found = drifted_paths(spark.createDataFrame(rows, "name string, value string"), TRANSACTION_JSON).collect()
    got = {}
    for r in found:
        got.setdefault(r.name, {})[r.path] = json.loads(r.json)
    deep = got.pop("arrays in arrays")
    assert list(deep) == ["metadata[0][0][0]"] and deep["metadata[0][0][0]"] == [{"z": 1}]
    assert got.pop("scalar") == {"$": 12}
    assert got == PATHS


def test_walking_shuffles_nothing(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    plan = drifted_paths(lines, TRANSACTION_JSON)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_lines_are_parsed_once_and_known_values_left_early(spark):
    lines = spark.createDataFrame([("{}",)], "value string").repartition(2)
    plan = drifted_paths(lines, TRANSACTION_JSON)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    tested = next(line for line in text.splitlines() if "from_json" in line)
    # the line once, its location and metadata once each
    assert tested.count("from_json") == 3 and "get_json_object" not in text and "jsonObjectKeys" not in text
    levels = text.count("Generate variant_explode")
    assert levels == 4 and text.count("Filter NOT (CASE WHEN") == levels


def test_texts_that_look_like_objects_or_come_twice(spark):
    texts = ['{"location":"{}"}', '{"location":{"x":1},"location":{}}', '[{"terminal":1}]', '\t{"terminal":[{"a":1}]}']
    texts += ['{"terminal":1} and more', '{"location":{"suburb":null}}', '{"location":{"city":{"z":1}}}', '{"a":1']
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {(r.value, r.path, r.json) for r in drifted_paths(lines, TRANSACTION_JSON).collect()}
    assert got == {
        (texts[2], "[0].terminal", "1"),
        (texts[3], "terminal", '[{"a":1}]'),
        (texts[4], "terminal", "1"),
        (texts[5], "location.suburb", "null"),
    }


def write(folder, **files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_each_file_by_its_own_header(spark, tmp_path):
    path = write(
        tmp_path / "csv",
        plain='a,b\n1,"x, y"\n2,\n',
        wider="b,c,a,d\nx,C,3,\ny,,4,D\n",
        fewer="b\nz\n\nb\n",
        torn='a,b\n5\n6,x,y\n7,ok\n8,"open\n',
        empty="a,b\n",
    )
    rows = read_csv_drifting(spark, path, ["a", "b"]).collect()
    got = sorted((r.a or "", r.b or "", str(r.unknown_columns or ""), r.malformed or "", r.source_file.rsplit("/", 1)[1]) for r in rows)
    assert got == sorted([
        ("1", "x, y", "", "", "plain.csv"), ("2", "", "", "", "plain.csv"),
        ("3", "x", "{'c': 'C'}", "", "wider.csv"), ("4", "y", "{'d': 'D'}", "", "wider.csv"),
        ("", "z", "", "", "fewer.csv"), ("7", "ok", "", "", "torn.csv"),
        ("", "", "", "5", "torn.csv"), ("", "", "", "6,x,y", "torn.csv"), ("", "", "", '8,"open', "torn.csv"),
    ])
    assert unknown_csv_columns(spark, path, ["a", "b"]) == ["c", "d"]
    assert csv_headers(spark, path).count() == 5


def test_headers_of_files_read_in_several_splits(spark, tmp_path):
    body = "".join(f"{i},{'v' * 50}\n" for i in range(2_000))
    path = write(tmp_path / "csv", one="a,b\n" + body, two="a,b,c\n" + body.replace("v\n", "v,w\n"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows = read_csv_drifting(spark, path, ["a", "b"])
        got = rows.agg(F.count("a"), F.countDistinct("a"), F.count("unknown_columns"), F.count("malformed")).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tuple(got) == (4_000, 2_000, 2_000, 0)


def test_no_files(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "x.csv").write_text("")
    assert read_csv_drifting(spark, str(tmp_path / "csv"), ["a"]).collect() == []


def test_drift_in_a_run(spark, sources, folder, tmp_path):  # noqa: F811
    inputs = sources([transaction(i, f"a{i}") for i in range(8)] + [transaction(8, "a8", location={"province": "Limpopo", "x": 1})])
    names = [*C.ACCOUNT_COLUMNS, "branch"]
    rows = [account(f"a{i}", f"c{i}") + (["B1"] if i == 3 else [""]) for i in range(3, 9)]
    wider = "\n".join(",".join(r) for r in [names, *rows]) + "\n"
    plain = "\n".join(",".join(r) for r in [list(C.ACCOUNT_COLUMNS), *[account(f"a{i}", f"c{i}") for i in range(3)]])
    accounts = write(tmp_path / "accounts", wider=wider, plain=plain + "\na9,c1\n")
    mixed = type(inputs)(inputs.customers, accounts, inputs.transactions)
    root = folder()
    log = run_with_rules(spark, mixed, root, RUN)
    store = LayerStore(spark, root, log.batch_id)
    assert store.read("star", "dim_accounts").count() == 9 and store.read("star", "fact_transactions").count() == 9
    assert aside(spark, store, "accounts") == [("MALFORMED_LINE", "", 1), ("UNKNOWN_COLUMNS", "", 1)]
    kept = {r.reason: json.loads(r.row_text) for r in spark.read.parquet(store.path("quarantine", "accounts")).collect()}
    assert kept["MALFORMED_LINE"]["malformed"] == "a9,c1" and kept["MALFORMED_LINE"]["source_file"].endswith("plain.csv")
    assert kept["UNKNOWN_COLUMNS"] == {
        "account_id": "a3", "source_file": kept["UNKNOWN_COLUMNS"]["source_file"], "path": "branch", "json": "B1"
    }
    drifted = spark.read.parquet(store.path("quarantine", "transactions")).collect()
    assert [json.loads(r.row_text) for r in drifted] == [{"transaction_id": "t08", "path": "location.x", "json": "1"}]
    assert sum("unknown columns" in w for w in log.warnings) == 2
    with pytest.raises(UnknownColumns, match="branch"):
        good = type(inputs)(inputs.customers, accounts, sources([transaction(0, "a0")]).transactions)
        run_with_rules(spark, good, folder(), RUN, drift_policy="strict")
