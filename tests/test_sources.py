"""Readers, result store, inventory and the folder run."""

import json
import os

import pytest
from pyspark.sql import functions as F

from plumbline.functions.names import is_free_text_table, name_has
from plumbline.plans.pipeline import run_folder, stage_features, stage_records
from plumbline.sources import documents as D
from plumbline.sources import inventory as I
from plumbline.sources import records as R
from plumbline.sources import results as S
from plumbline.sources import tabular as T

CSV = 'order_id,price,note,created_at\n1,9.5,"said ""hi"", left\nnext line",2024-05-01\n2,,,2024-05-02\n'
MAIL = (
    b"Subject: Hello\nMIME-Version: 1.0\nContent-Type: multipart/alternative; boundary=b\n\n"
    b"--b\nContent-Type: text/plain; charset=iso-8859-1\n\ncaf\xe9 body\n"
    b"--b\nContent-Type: text/html\n\n<p>no</p>\n--b--\n"
)


@pytest.fixture()
def folder(tmp_path):
    def write(name, content):
        path = tmp_path / name
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(path)

    write.root = str(tmp_path)
    return write


def texts(records):
    return sorted(r[0] for r in records.select(F.to_json("v")).collect())


def test_csv(spark, folder):
    df = T.load_table(spark, folder("orders.CSV", CSV))
    assert dict(df.dtypes)["price"] == "double" and dict(df.dtypes)["order_id"] == "int"
    rows = df.orderBy("order_id").collect()
    assert rows[0].note == 'said "hi", left\nnext line' and rows[1].note is None and rows[1].price is None


@pytest.mark.parametrize("suffix", [".parquet", ".pq"])
def test_parquet_keeps_its_schema(spark, folder, suffix):
    path = f"{folder.root}/t{suffix}"
    spark.sql("SELECT 1S AS a, DATE'2024-01-01' AS d").write.parquet(path)
    assert T.load_table(spark, path).dtypes == [("a", "smallint"), ("d", "date")]


def test_source_errors(spark, folder):
    with pytest.raises(FileNotFoundError):
        T.load_table(spark, f"{folder.root}/absent.csv")
    with pytest.raises(ValueError, match="unsupported"):
        T.load_table(spark, folder("a.xyz", "x"))
    for source in ("sqlite:///db.sqlite", "sqlite:///db.sqlite|  "):
        with pytest.raises(ValueError):
            T.jdbc_reader_options(source)
    with pytest.raises(ValueError, match="unsupported"):
        R.load_records(spark, folder("b.txt", "x"))
    with pytest.raises(ValueError, match="unsupported"):
        D.load_documents(spark, folder("c.json", "{}"))


def test_sql_sources():
    assert T.split_sql_source("sqlite:///db|orders") == ("sqlite:///db", "SELECT * FROM orders")
    assert T.split_sql_source("sqlite:///db|select 1") == ("sqlite:///db", "select 1")
    assert T.split_sql_source("sqlite:///db|selected")[1] == "SELECT * FROM selected"
    assert T.jdbc_url("postgresql://me:pw@host:1/db") == ("jdbc:postgresql://host:1/db", {"user": "me", "password": "pw"})
    assert T.jdbc_url("sqlite:////tmp/x.db")[0] == "jdbc:sqlite:/tmp/x.db"
    assert T.jdbc_url("mssql://sa@h/d") == ("jdbc:sqlserver://h;databaseName=d", {"user": "sa"})
    parallel = T.jdbc_reader_options("jdbc:x:y|t", partitionColumn="id", numPartitions="8")
    assert parallel["dbtable"] == "(SELECT * FROM t) source" and "query" not in parallel


def test_json_documents(spark, folder):
    array, kind = R.load_records(spark, folder("a.json", '[{"a": 1},\n {"b": [2]}, 3]'))
    assert kind == "json" and texts(array) == ['{"a":1}', '{"b":[2]}', '{"value":3}']
    single, _ = R.load_records(spark, folder("o.json", '{"a": {"b": 1}}'))
    assert texts(single) == ['{"a":{"b":1}}']


def test_json_lines_skip_malformed_ones(spark, folder):
    path = folder("e.jsonl", '{"a":1}\n\n{"a":1} trailing\n{broken\n  {"a":2,"a":3}\n')
    records, kind = R.load_records(spark, path)
    assert kind == "jsonl" and texts(records) == ['{"a":1}', '{"a":3}']
    assert tuple(R.malformed_lines(spark, path).first()) == (4, 2)


def test_log_lines(spark, folder):
    records, kind = R.load_records(spark, folder("app.log", '{"level":"INFO"}\n\nplain "text"\n5\n[1]\n'))
    assert kind == "log"
    assert texts(records) == ['{"level":"INFO"}', '{"raw_line":"plain \\"text\\""}', '{"value":5}', '{"value":[1]}']


def test_xml(spark, folder):
    path = folder("x.xml", '<root><item id="7"><tag>a</tag><tag>b</tag><note lang="en">hi</note></item><item id="8"/></root>')
    records, kind = R.load_records(spark, path, row_tag="item")
    row = {r.id: r for r in records.collect()}[7]
    assert kind == "xml" and row.tag == ["a", "b"] and (row.note._text, row.note.lang) == ("hi", "en")
    mixed = folder("m.xml", '<root><item id="7"/><item id="8"/><note>hi</note></root>')
    rows, _ = R.load_records(spark, mixed)
    got = sorted(json.dumps(json.loads(r.j), sort_keys=True) for r in rows.selectExpr("to_json(v) AS j").collect())
    assert got == ['{"id": 7}', '{"id": 8}', '{"note": "hi"}']


def test_text_encodings(spark, folder):
    folder("u.txt", "naïve ☃".encode())
    folder("l.txt", "café".encode("latin-1"))
    docs = {r.doc_id: r for r in D.load_documents(spark, folder.root + "/*.txt").collect()}
    assert docs["u"].text == "naïve ☃" and docs["l"].text == "café"
    assert docs["u"].modified_at is not None and docs["u"].source_path.endswith("u.txt")


def test_email(spark, folder):
    folder("m.eml", MAIL)
    folder("n.eml", b"From: x\n\nonly body")
    docs = {r.doc_id: r.text.strip() for r in D.load_documents(spark, folder.root + "/*.eml").collect()}
    assert docs == {"m": "Subject: Hello\ncafé body", "n": "only body"}


def test_rows_as_documents(spark, folder):
    rows = D.load_documents(spark, folder("c.csv", "id,body,more\n1,hello,x\n2,,y\n")).orderBy("text").collect()
    assert [r.text for r in rows] == ["hello x", "y"] and rows[0].format == "csv"


def test_csv_spellings_of_missing(spark, folder):
    rows = T.read_csv(spark, folder("n.csv", "v,w,d,b\nNA,x,2024-01-02,true\n5,N/A,null,False\nnull,None,,NaN\n"))
    assert dict(rows.dtypes) == {"v": "int", "w": "string", "d": "date", "b": "boolean"}
    assert sum(r.v is None for r in rows.collect()) == 2 and rows.where("w is null").count() == 2


def test_lines_of_white_space_are_blank(spark, folder):
    path = folder("w.log", "\t\n\u3000 \nhello\n")
    assert [r.j for r in R.read_log(spark, path).selectExpr("to_json(v) AS j").collect()] == ['{"raw_line":"hello"}']


def test_unknown_charsets_do_not_stop_the_others(spark, folder):
    folder("a.eml", 'Subject: a\nContent-Type: text/plain; charset="no-such"\n\nbody a')
    folder("b.eml", "Subject: b\n\nbody b")
    got = sorted(r.text for r in D.read_email(spark, folder.root, ".eml").collect())
    assert got == ["Subject: a\nbody a", "Subject: b\nbody b"]


def test_free_text_headers(spark):
    assert is_free_text_table(spark.createDataFrame([("a",)], ["Comment_Text"]))
    assert not is_free_text_table(spark.createDataFrame([("a",)], ["price"]))
    assert name_has("userId", ("id",), strict=True) and not name_has("width", ("id",), strict=True)


def test_inventory(spark, folder):
    for name in ("b.csv", "a.json", "c.TXT", "d.bin"):
        folder(name, "x")
    files = I.list_files(spark, folder.root)
    assert {(r.stem, r.data_type) for r in files.collect()} == {("b", "structured"), ("a", "semi_structured"), ("c", "text"), ("d", None)}
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_raw_source_lookup(spark):
    raw = I.with_routes(spark.createDataFrame([("r/a.jsonl",), ("r/a.json",)], "path string"))
    extracted = I.with_routes(spark.createDataFrame([("x/a_extracted.csv",), ("x/b_extracted.csv",), ("x/c.csv",)], "path string"))
    got = {r.extracted_path: r.raw_path for r in I.match_raw_sources(extracted, raw).collect()}
    assert got == {"x/a_extracted.csv": "r/a.json", "x/b_extracted.csv": None}


def test_result_json_shapes(spark, folder):
    one = {"dataset_name": "a", "data_type": "text", "overall_score": 50, "dimensions": {"accuracy": 1}, "failed_checks": [], "metadata": {"n": 1}, "passed": False, "run_timestamp": "2024-01-01T00:00:00Z", "source_path": ""}
    bare = S.read_result_json(spark, folder("l.json", json.dumps([one, one])))
    wrapped = S.read_result_json(spark, folder("d.json", json.dumps({"datasets": [one]})), "r9")
    assert bare.count() == 2 and wrapped.first().run_id == "r9" and wrapped.first().overall_score == 50.0
    with pytest.raises(Exception, match="expected a JSON list"):
        S.read_result_json(spark, folder("x.json", "{}")).collect()


def test_folder_run(spark, folder, tmp_path_factory):
    folder("orders.csv", CSV)
    folder("comments.csv", "id,comment_text\n1,good\n2,bad\n")
    folder("users.json", '[{"id": 1, "created_at": "2024-05-30"}]')
    folder("broken.json", "{not json")
    folder("report.txt", "The cat and the dog. " * 20)
    folder("m.eml", MAIL)
    store = str(tmp_path_factory.mktemp("store") / "results")
    assert S.read_results(spark, store).count() == 0
    assert run_folder(spark, folder.root, store, "r1", "2024-06-01") == 1
    first = {(r.dataset_name, r.data_type) for r in S.read_results(spark, store).collect()}
    assert len(first) == 8 and {("orders", "structured"), ("comments", "structured"), ("users", "semi_structured"), ("report", "text"), ("m", "text")} <= first
    failed = S.read_results(spark, store).where("dataset_name = 'broken'").first()
    assert failed.overall_score == 0 and len(failed.failed_checks) == 6
    run_folder(spark, folder.root, store, "r2", "2024-06-01")
    stored = S.read_results(spark, store)
    assert stored.groupBy("run_id").count().count() == 2 and stored.count() == 16
    for _ in range(2):
        S.replace_run(stored.where("run_id = 'r1'"), store + "_copy")
    assert S.read_results(spark, store + "_copy").count() == 8


def test_folder_run_leaves_no_file_out(spark, folder, tmp_path_factory):
    text = "The cat and the dog are in the house. " * 20
    folder("a.txt", text)
    folder("B.TXT", text + "More of it here.")
    folder("d.pdf", "x")
    folder("ok.eml", "Subject: s\n\nhello")
    folder("bad.eml", 'Subject: s\nContent-Type: text/plain; charset="none-such"\n\nhello')
    folder("rec.jsonl", '{"a b": 1}\n{"c d": 2}')
    os.makedirs(f"{folder.root}/sub")
    folder("sub/c.txt", text)
    store = str(tmp_path_factory.mktemp("store") / "results")
    for _ in range(2):
        assert run_folder(spark, folder.root, store, "r1", "2024-06-01") == 1
    got = {r.dataset_name: r for r in S.read_results(spark, store).collect()}
    assert S.read_results(spark, store).count() == len(got) == 7
    assert set(got) == {"a", "B", "c", "d", "ok", "bad", "rec"}
    assert got["d"].overall_score == 0 and "unsupported" in got["d"].failed_checks[0].actual
    # Likely duplicates across files and folders, and across formats.
    assert got["a"].dimensions.uniqueness == got["c"].dimensions.uniqueness == 0
    assert got["ok"].dimensions.uniqueness == got["bad"].dimensions.uniqueness == 0 and got["B"].dimensions.uniqueness == 100
    checks = S.read_run_checks(spark, store).where("dataset_name = 'rec'")
    assert got["rec"].failed_checks == [] and checks.where("check = 'invalid_field_name'").count() == 2


def test_staging(spark, tmp_path):
    records = spark.sql("""SELECT parse_json('{"a":{"b":1}}') AS v""")
    stage_records(records, str(tmp_path / "leaves"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "leaves")).collect()] == [(0, "a.b", "1")]
    docs = spark.createDataFrame([("x", "the text")], "doc_id string, text string")
    for run in ("r1", "r2", "r2"):
        stage_features(docs, str(tmp_path / "features"), run, "2024-01-01")
    assert spark.read.parquet(str(tmp_path / "features")).count() == 2
