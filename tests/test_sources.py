"""Readers and writers on literal files."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemill.operators.quality import range_status, text_number_status
from tidemill.sources import files, html, nested, sinks

STUDENT = "id int, name string, marks int"


def test_delimited_text(spark, tmp_path):
    path = tmp_path / "students.txt"
    path.write_text(" 1 , Oda , 85 \n2, Per,\n3,Ulf, -5\n4,\tInes,\xa0105\n", encoding="utf-8")
    df = files.read_text_delimited(spark, str(path), ["id", "name", "marks"])
    rows = df.select("id", "name", text_number_status("marks", 0, 100).alias("s")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        ("1", "Oda", "ok"), ("2", "Per", "missing"), ("3", "Ulf", "anomaly"), ("4", "Ines", "anomaly"),
    ]


def test_csv_null_tokens_and_bad_numbers(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('id,name,marks\n1,N/A, 85 \n2,Per,NA\n3,"A ""b"", c",x\n4,,105\n')
    df = files.read_csv(spark, str(path), STUDENT)
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, None, 85), (2, "Per", None), (3, 'A "b", c', None), (4, None, 105),
    ]
    text = files.read_csv_text(spark, str(path))
    assert [(r["id"], r["failed_columns"]) for r in files.cast_failures(text, STUDENT).collect()] == [("3", "marks")]
    status = df.select("id", range_status(F.col("marks"), 0, 100).alias("s"))
    assert {r["id"]: r["s"] for r in status.collect()} == {1: "ok", 2: "missing", 3: "missing", 4: "anomaly"}


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("marks,extra,id,name\n85,x,1,Oda\n")
    assert tuple(files.read_csv(spark, str(tmp_path / "a.csv"), STUDENT).first()) == (1, "Oda", 85)
    (tmp_path / "b.csv").write_text("id,name,marks,extra\n2,Per,92,y\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], STUDENT).collect()


def test_csv_inferred_types_and_several_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,2.5\n")
    (tmp_path / "b.csv").write_text("id,v\n2,3.5\n")
    df = files.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert df.dtypes == [("id", "int"), ("v", "double")] and df.count() == 2


def test_csv_latin1(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_bytes("id,name,marks\n1,México,5\n".encode("latin1"))
    assert files.read_csv(spark, str(path), STUDENT, encoding="ISO-8859-1").first()["name"] == "México"


def test_csv_dates(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("id,at\n1,1/31/2018 22:56\n2,soon\n")
    df = files.read_csv(spark, str(path), "id int, at timestamp_ntz", timestamp_format="M/d/yyyy H:mm")
    assert [r["at"] for r in df.orderBy("id").collect()] == [datetime(2018, 1, 31, 22, 56), None]
    text = files.read_csv_text(spark, str(path))
    failed = files.cast_failures(text, "id int, at timestamp_ntz", timestamp_format="M/d/yyyy H:mm").collect()
    assert [(r["id"], r["failed_columns"]) for r in failed] == [("2", "at")]


def test_csv_sink_keeps_spaces_quotes_and_breaks(spark, tmp_path):
    rows = [(1, ' a "q", \n b ', 1), (2, "As Seen on  TV!", None), (3, None, 3)]
    df = spark.createDataFrame(rows, STUDENT)
    path = sinks.write_csv(df, str(tmp_path / "out"))
    assert sorted(map(tuple, files.read_csv(spark, path, STUDENT, multi_line=True).collect())) == rows


def test_extracted_csv_is_bound_by_name(spark, tmp_path):
    path = tmp_path / "places.csv"
    path.write_text("country,city,id\nFR,Paris,1\nNA,Oslo,2\n")
    rows = files.extract_csv(spark, str(path), "id int, country string, city string").collect()
    assert [tuple(r) for r in rows] == [(1, "FR", "Paris"), (2, None, "Oslo")]
    assert files.extract_csv(spark, str(tmp_path / "none.csv"), "id int").count() == 0


def test_an_error_without_text_does_not_stop_the_export(spark, tmp_path):
    def build(name):
        if name == "bad":
            raise KeyError
        return spark.range(3)

    audit = sinks.export_each(spark, ["bad", "good"], build, str(tmp_path), sinks.write_csv).collect()
    assert [(r["name"], r["status"]) for r in audit] == [("bad", "failed"), ("good", "ok")]


def test_html_first_table(spark):
    page = (
        "<html><table><tr><th>ID</th><th>Name</th><th>Marks</th></tr><tr><td>1<td> Oda &amp;\n Co</td><td>85</td>"
        "</tr><tr><td>2</td><td>Per</td><td></td></tr></table><table><tr><td>other</td></tr></table></html>"
    )
    pages = spark.createDataFrame([(7, page), (8, None), (9, "<p>none</p>")], "page int, html string")
    rows = html.extract_html_tables(pages, "page", "html")
    assert rows.filter("is_header").first()["cells"] == ["ID", "Name", "Marks"]
    body = html.pick_table(rows, 0, ["id", "name", "marks"]).orderBy("row_idx").collect()
    assert [tuple(r)[2:] for r in body] == [("1", "Oda & Co", "85"), ("2", "Per", "")]
    assert rows.filter("table_idx = 1").first()["cells"] == ["other"]


def test_html_parser_travels_without_the_package(tmp_path):
    from pyspark import cloudpickle

    packed = tmp_path / "parser.bin"
    packed.write_bytes(cloudpickle.dumps(html.table_rows))
    code = (
        f"import pickle; rows = pickle.load(open({str(packed)!r}, 'rb'))('<table><tr><td>a</td></tr></table>'); "
        "import importlib.util as u; assert u.find_spec('tidemill') is None; print(rows)"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    assert done.stdout.strip() == "[(0, 0, False, ['a'])]"


def test_html_spans_are_filled(spark):
    rows = html.table_rows(
        "<table><tr><th colspan=2>a</th><th rowspan='2'>b</th></tr><tr><td>1</td><td>2</td></tr>"
        "<tr><td rowspan=3 colspan=x>p</td><td>3</td><td>4</td></tr><tr><td>5</td></tr></table>"
    )
    assert [r[3] for r in rows] == [["a", "a", "b"], ["1", "2", "b"], ["p", "3", "4"], ["p", "5"]]
    assert [r[2] for r in rows] == [True, False, False, False]


def test_html_row_spans_beyond_a_thousand_and_to_the_end_of_a_group():
    rows = html.table_rows("<table><tr><td rowspan=1500>a<td>0</tr>" + "<tr><td>x</tr>" * 1499 + "<tr><td>last</tr></table>")
    assert [r[3] for r in rows[1:1500]] == [["a", "x"]] * 1499 and rows[1500][3] == ["last"]
    rows = html.table_rows(
        "<table><tbody><tr><td rowspan=0>a<td>1</tr><tr><td>2</tr><tr><td>3</tr></tbody><tbody><tr><td>4</tr></tbody></table>"
    )
    assert [r[3] for r in rows] == [["a", "1"], ["a", "2"], ["a", "3"], ["4"]]


def test_html_header_rows():
    body = "<tr><td>1</tr><tr><th>middle</tr><tr><td>2</tr>"
    headed = html.table_rows(f"<table><thead><tr><td>h</tr></thead><tbody>{body}</tbody></table>")
    assert [r[2] for r in headed] == [True, False, False, False]
    leading = html.table_rows(f"<table><tr><th>h</tr><tr><th>h</tr>{body}</table>")
    assert [r[2] for r in leading] == [True, True, False, False, False]


def test_html_nested_table(spark):
    assert html.table_rows("<table><tr><td>a<table><tr><td>in</td></tr></table></td><td>b</td></tr>") == [
        (0, 0, False, ["a", "b"]), (1, 0, False, ["in"]),
    ]


def test_xml(spark, tmp_path):
    path = tmp_path / "s.xml"
    path.write_text(
        "<students><student><id>1</id><name>Oda</name><marks>85</marks></student>"
        "<student><id>2</id><name>Per</name><marks></marks></student></students>"
    )
    df = files.read_xml(spark, str(path), "student", STUDENT)
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, "Oda", 85), (2, "Per", None)]


def test_json_array(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps([{"id": 1, "name": "a", "marks": None}, {"id": 2, "name": "b", "marks": 105}], indent=1))
    df = files.read_json_array(spark, str(path), STUDENT)
    got = df.select(range_status(F.col("marks"), 0, 100).alias("s")).collect()
    assert [r["s"] for r in got] == ["missing", "anomaly"]


def test_binary(spark, tmp_path):
    (tmp_path / "sample.bin").write_bytes(b"Data Engineering Practical")
    row = files.read_binary(spark, str(tmp_path / "sample.bin")).first()
    assert row["length"] == 26 and bytes(row["content"]) == b"Data Engineering Practical"


def test_missing_path_is_empty_and_other_errors_are_raised(spark, tmp_path):
    empty = files.extract_csv(spark, str(tmp_path / "no.csv"), "id int, city string")
    assert empty.isEmpty() and empty.columns == ["id", "city"]
    assert files.merge_if_present(spark.range(3), empty.select(F.col("id").cast("long")), "id") is None
    (tmp_path / "x.parquet").write_text("not parquet")
    with pytest.raises((AnalysisException, Exception)):
        files.read_or_empty(spark, str(tmp_path / "x.parquet"), "id int").collect()


def test_flatten(spark):
    df = spark.createDataFrame([(1, (("a", 2), "x"))], "id int, u struct<c: struct<name: string, n: int>, e: string>")
    flat = nested.flatten_struct(df)
    assert flat.columns == ["id", "u.c.name", "u.c.n", "u.e"]
    assert tuple(flat.first()) == (1, "a", 2, "x")


def test_export_isolates_errors(spark, tmp_path):
    tables = {"a": spark.range(3), "none": spark.range(0), "bad": spark.range(3).select(F.raise_error(F.lit("x")))}
    audit = sinks.export_tables(spark, ["a", "bad", "unknown", "none"], tables, str(tmp_path))
    got = {r["name"]: (r["rows"], r["status"]) for r in audit.collect()}
    assert got == {"a": (3, "ok"), "bad": (None, "failed"), "unknown": (None, "failed"), "none": (0, "ok")}
    assert sinks.success_line(audit) == "2/4"
