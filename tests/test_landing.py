"""Unreadable documents: found with file and line, kept once, repaired and landed; contracts checked whole."""

import json

import pytest
from pyspark.sql import functions as F

from resalelake.sources import contracts, landing, payloads

GOOD = {"id": "1", "name": "#1", "line_items": [{"id": "a", "quantity": 2}]}
BAD = {
    '{"id": "3"': "malformed",
    '{"id": "4"} {"id": "5"}': "malformed",
    '{"id": "6"} and more': "malformed",
    '[{"id": "7"}]': "malformed",
    '"text"': "malformed",
    "null": "malformed",
    "oops": "malformed",
    '{"id": "8"} and more}': "malformed",
    '{"id": "8"},{"id": "9"}': "malformed",
    '{"id": "8"}]': "malformed",
    '{"id": "8"}}]': "malformed",
    '{"id": "8"}, 1]': "malformed",
    "{}": "no id",
    '{"id": "", "name": "#9"}': "no id",
}
ODD_BUT_GOOD = ['{"id": "10", "name": "}{"}', '  {"id": 11}  ', '{"id": "12", "line_items": "none"}', '{"id": "13", "name": "\\u00e9 } {"}']


@pytest.fixture
def folder(spark, tmp_path):
    """Two files; with small blocks a task reads a part of a file."""
    lines = [json.dumps(GOOD | {"id": str(100 + k)}) for k in range(400)]
    for k, text in enumerate([*BAD, *ODD_BUT_GOOD, "", "   "]):
        lines.insert(11 + 23 * k, text)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("\n".join(lines))
    (tmp_path / "in/b.json").write_text("\n".join([*BAD, json.dumps(GOOD)]) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield str(tmp_path / "in")
    for k, v in before.items():
        spark.conf.set(k, v)


def test_letters_have_their_place(spark, folder, tmp_path):
    box = str(tmp_path / "letters")
    for _ in range(2):
        docs = landing.land(spark, "order", folder, box)
    assert docs.count() == 400 + len(ODD_BUT_GOOD) + 1
    rows = landing.open_letters(spark, box).collect()
    assert len(rows) == 2 * len(BAD)
    for r in rows:
        text = open(r.file.removeprefix("file:")).read().split("\n")[r.line - 1]
        assert (text, r.reason) == (r.body, BAD[text])
    assert landing._lines(spark, folder).select("file", "block").distinct().count() > 3
    assert payloads.read_landing(spark, "order", folder).count() == docs.count()


def test_replay(spark, folder, tmp_path):
    box = str(tmp_path / "letters")
    landing.land(spark, "order", folder, box)
    repair = "CASE WHEN body LIKE '{\"id\": \"3\"' THEN body || '}' WHEN body = 'oops' THEN '{\"id\": \"77\"}' ELSE body END"
    fixed = landing.replay(spark, "order", box, repair)
    assert sorted(r.id for r in fixed.collect()) == ["3", "3", "77", "77"]
    assert landing.replay(spark, "order", box, repair).count() == 0
    assert landing.open_letters(spark, box).count() == 2 * (len(BAD) - 2)
    landing.land(spark, "order", folder, box)
    assert landing.open_letters(spark, box).count() == 2 * (len(BAD) - 2)
    assert landing.replay(spark, "refund", box).count() == 0


def test_three_lines_two_broken(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.json").write_text(json.dumps(GOOD) + '\n{"id": \nnot json')
    docs = landing.land(spark, "order", str(tmp_path / "in"), str(tmp_path / "box"))
    assert [r.order_id for r in payloads.flatten_orders(docs, "shop", None).collect()] == ["1"]
    assert [(r.line, r.reason) for r in landing.open_letters(spark, str(tmp_path / "box")).orderBy("line").collect()] == [(2, "malformed"), (3, "malformed")]


def test_contract_report(spark):
    df = spark.createDataFrame([("1", "x", "1.5", 1), (None, "2001-01-01", "free", 2), ("3", None, "2", 3)], "customer_id string, date string, customer_aov string, extra int")
    rows = {r.column_name: r for r in contracts.contract_report(df, "customers").collect()}
    assert set(rows) == {f.name for f in contracts.contract("customers").fields} | {"extra"}
    assert tuple(rows["customer_id"])[1:] == ("ok", "string", "string", 3, 2, 0)
    assert tuple(rows["date"])[1:] == ("type", "date", "string", 3, 2, 1)
    assert tuple(rows["customer_aov"])[1:] == ("type", "decimal(18,4)", "string", 3, 3, 1)
    assert tuple(rows["extra"])[1:] == ("unexpected", None, "int", 3, 3, 0)
    assert tuple(rows["customer_tags"])[1:] == ("missing", "string", None, 3, 0, 0)
    plan = contracts.contract_report(df.withColumn("n", F.lit(1)), "customers")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1
