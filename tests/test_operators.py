"""Operators on rows small enough to check by eye."""

import json

import pytest
from pyspark.sql import functions as F

from tallspan.catalog import Column, parse_files, parse_sources, parse_tables
from tallspan.functions import codecs
from tallspan.operators.jsonflat import flatten_json
from tallspan.operators.project import to_records
from tallspan.operators.recon import observed, recon, validate_recon
from tallspan.operators.reshape import matched
from tallspan.operators.rowkey import build_key, with_key_fields
from tallspan.plans import engine
from tallspan.plans.job import Job, JobConfig, load_catalog, report_frame, run_jobs
from tallspan.catalog import Catalog
from tallspan.errors import AnalysisError
from tallspan.sources import cells as scans
from tallspan.sources.bookmarks import Bookmarks
from tallspan.sources.sinks import CellTable, DelimitedFiles, ManagedTable, load_script

SPEC = parse_sources("s:s->RK=|:st|ok->D.TOT:int::,D.NOTE:string::,D.Q<X>:string::,D.F<X>:string::->X=|:ln|pk;")[0]


def cells(spark, rows):
    """rows: key, qualifier, value (text or bytes), and if given ts and type."""
    full = [(k.encode(), "D", q, (more or [1])[0], more[1] if len(more) > 1 else "put", v.encode() if isinstance(v, str) else v) for k, q, v, *more in rows]
    return spark.createDataFrame(full, scans.SCHEMA)


@pytest.fixture(scope="module")
def stored(spark):
    nine = (9).to_bytes(4, "big")
    return cells(spark, [("F|7", "TOT", nine), ("F|7", "Q1|a", "5"), ("F|7", "F1|a", "R"), ("F|7", "Q2|b", "6"), ("F|7", "F2|b", "N"), ("F|7", "Q3", "1"), ("O|8", "TOT", nine), ("O|9", "Q1", "x"), ("O|9", "TOT", nine)]).cache()


def rows(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def test_unpivot(stored):
    out = engine.run(stored, SPEC, "select D.Q<X> from s")
    assert rows(out, "st", "ok", "ln", "pk", "Q") == [("F", "7", "1", "a", "5"), ("F", "7", "2", "b", "6")]
    out = engine.run(stored, SPEC, "select D.Q<X> from s where D.F<X> = 'R'")
    assert rows(out, "ln", "Q", "F") == [("1", "5", "R")]
    out = engine.run(stored, SPEC, "select D.Q<X> from s where D.F<X> = 'R' or D.TOT = '9'")
    assert rows(out, "ln", "TOT") == [("1", 9), ("2", 9)]
    out = engine.run(stored, SPEC, "select D.TOT from s where D.F<X> = 'null'")
    assert rows(out, "st", "ok", "TOT") == [("O", "8", 9), ("O", "9", 9)]  # Q isn't read
    assert "9" not in {r.ok for r in engine.run(stored, SPEC, "select D.TOT from s where D.Q<X> = 'null'").collect()}  # a malformed part only


@pytest.mark.parametrize(
    ("where", "there", "absent"),
    [
        ("D.NOTE = 'Y'", True, False), ("D.NOTE = 'N'", False, False), ("D.NOTE != 'N'", True, False), ("D.NOTE = 'null'", False, True), ("D.NOTE != 'NULL'", True, False),
        ("D.NOTE REGEXP 'Y'", True, False), ("D.NOTE REGEXP '.'", True, False), ("D.NOTE REGEXP 'YY?Z'", False, False), ("D.NOTE NOT REGEXP 'N'", True, False),
        ("D.TOT > '8'", True, True), ("D.TOT <= '10' and D.NOTE = 'Y'", True, False), ("D.TOT != '9' or D.NOTE = 'null'", False, True), ("D.TOT >= 9 and (D.NOTE = 'X' or ok = 'k1')", True, False),
    ],
)
def test_predicates(spark, where, there, absent):
    nine = (9).to_bytes(4, "big")
    data = cells(spark, [("s|k1", "TOT", nine), ("s|k1", "NOTE", "Y"), ("s|k2", "TOT", nine)])
    out = {r.ok for r in engine.run(data, SPEC, f"select D.TOT from s where {where}").collect()}
    assert out == ({"k1"} if there else set()) | ({"k2"} if absent else set())


def test_text_null_counts_as_null(spark):
    data = cells(spark, [("s|k", "NOTE", "null"), ("s|l", "NOTE", "x")])
    assert rows(engine.run(data, SPEC, "select D.NOTE from s where D.NOTE = 'null'"), "ok") == [("k",)]


def test_pushdown(stored, tmp_path, spark):
    stored.write.parquet(str(tmp_path / "c"))
    plan = engine.run(scans.scan(spark, str(tmp_path / "c")), SPEC, "select D.TOT from s where st = 'F' and ok = '7'")._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1].split("]")[0]
    assert "EqualTo(row_key" in pushed and "qualifier" in pushed and "BatchEvalPython" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_key_ranges(spark, stored):
    assert scans.after_prefix(b"a\xff") == b"b" and scans.after_prefix(b"\xff") is None
    assert scans.with_prefix(stored, b"O|").select("row_key").distinct().count() == 2
    assert scans.key_bytes(SPEC, {"st": "F"}) == (b"F|", False) and scans.key_bytes(SPEC, {"st": "F", "ok": "7"}) == (b"F|7", True)


def test_row_keys(spark):
    spec = parse_sources('k:k->RK=|:hash(rt)[0:6]|fp|rt|code="07"->D.A:string::;')[0]
    made = spark.createDataFrame([("2020", "R1")], "fp string, rt string").select(build_key(spec).alias("row_key"))
    key = made.first()[0]
    assert key[1:] == b"2020|R1|07" and key[0] == codecs.salt_byte("R1", 7) and key[0] % 2 == 0
    bad = spark.createDataFrame([(key[:1] + x,) for x in (b"2020|R1|08", b"2020|R1", b"2020||", b"2020|R1|07|z")], "row_key binary")
    assert rows(with_key_fields(made.unionByName(bad), spec), "fp", "rt") == [("2020", "R1")]


def test_longest_affix(spark):
    columns = tuple(Column("D", n, prefix=p, suffix=s, placeholder="X") for n, p, s in (("A", "A", ""), ("AB", "AB", ""), ("yz", "", "yz"), ("XYZ", "", "xyz"), ("X", "", "")))
    data = spark.createDataFrame([("D", q) for q in ("A1", "AB1", "AB1yz", "AB1xyz", "1", "E9")], "family string, qualifier string")
    out = {r.qualifier: (r.m.label, r.m.part) for r in data.withColumn("m", matched(columns)).collect()}
    assert out == {"A1": ("A", "1"), "AB1": ("AB", "1"), "AB1yz": ("AB", "1yz"), "AB1xyz": ("XYZ", "AB1"), "1": ("X", "1"), "E9": ("X", "E9")}


def test_codecs(spark):
    values = [("int", "-5"), ("int", "2147483647"), ("long", "-9223372036854775808"), ("long", "77"), ("double", "-2.5"), ("float", "0.5"), ("decimal", "-12.3400000000"), ("biginteger", "-300"), ("biginteger", "128")]
    for type_, text in values:
        data = spark.createDataFrame([(text,), (None,)], "t string").select(codecs.encoded(F.col("t"), type_).alias("b"))
        got = [r[0] for r in data.select(codecs.decoded(F.col("b"), type_)).collect()]
        assert float(got[0]) == float(text) and got[1] is None, type_
    data = spark.createDataFrame([("text " * 9,), (None,)], "t string").select(codecs.to_snappy(F.col("t")).alias("b"))
    assert [r[0] for r in data.select(codecs.decoded(F.col("b"), "int", codec="snappy")).collect()] == ["text " * 9, None]
    assert codecs.unsnap(b"plain, no snappy") == "plain, no snappy"
    dates = spark.createDataFrame([("31/12/2019",), ("x",)], "t string")
    assert [r[0] for r in dates.select(codecs.iso_date(F.col("t"), "dd/MM/yyyy")).collect()] == ["2019-12-31", None]


DOC = {"A": {"B": {"AB1": "1", "AB2": 2.50}, "D": {"E": {"ADE": "d"}}}, "1": {"2": {"12": "t"}, "3": [{"131": "p", "133": "q"}, {"131": "r", "134": "z"}, {"135": "no"}], "4": ["x", "y"]}, "n": None}


def flat(spark, doc, paths):
    data = spark.createDataFrame([("k", doc if isinstance(doc, str) else json.dumps(doc))], "k string, J string")
    out = flatten_json(data, "J", paths)
    return sorted((tuple(r[p] for p in paths) for r in out.collect()), key=repr)


def test_json(spark):
    assert flat(spark, DOC, ["A#B#AB1", "A#B#AB2", "A#D#E#ADE"]) == [("1", "2.5", "d")]
    assert flat(spark, DOC, ["AB1", "ADE"]) == [(None, None)]
    assert flat(spark, DOC, ["A#B#AB1", "1#3#131", "1#3#133", "1#4"]) == [("1", "p", "q", "x"), ("1", "p", "q", "y"), ("1", "r", None, "x"), ("1", "r", None, "y")]
    two = {"A": "a", "B": [{"BD": 1}, {"BE": 2}, {"X": 3}], "C": [{"CE": 4}, {"CF": 5}, {}]}
    assert len(flat(spark, two, ["A", "B#BD", "B#BE", "C#CE", "C#CF"])) == 4
    top = [{"rt": 1, "items": [{"no": 1}, {"no": 2}]}, {"rt": 2, "items": [{"no": 3}, {"no": 4}]}]
    assert flat(spark, top, ["rt", "items#no"]) == [("1", "1"), ("1", "2"), ("2", "3"), ("2", "4")]
    assert flat(spark, {"id": 1, "it": [{"n": "a"}, {"z": 0}, {"n": "b"}], "tag": ["x", "y"]}, ["id", "it#n", "tag"]) == [("1", "a", "x"), ("1", "a", "y"), ("1", "b", "x"), ("1", "b", "y")]
    assert flat(spark, {"id": 1, "it": [], "tag": ["[odd"]}, ["id", "it#n", "tag"]) == [("1", None, "[odd")]
    assert flat(spark, {"n": None}, ["n"]) == [(None,)]
    with pytest.raises(Exception, match="JSON root"):
        flatten_json(spark.createDataFrame([("5",)], "J string"), "J", ["a"], check_root=True).collect()


def test_recon(spark):
    data = spark.createDataFrame([("1.5", "a"), ("null", None), ("\\N", "b"), ("2", "null")], "v string, t string")
    got = recon(data, {"v": ["SUM", "count"], "t": ["count"]}, 2).first().asDict()
    assert (got["rows"], float(got["sum_v"]), got["count_v"], got["count_t"]) == (4, 3.5, 2, 2)
    assert float(recon(data.limit(0), {"v": ["sum"]}).first()["sum_v"]) == 0
    seen, o = observed(data, {"t": ["count"]})
    seen.collect()
    assert o.get == {"rows": 4, "count_t": 2}
    with pytest.raises(AnalysisError):
        validate_recon(parse_files("t=a:string:;")[0], {"a": ["sum"]})


EV = parse_sources("e:e->RK=k->D.A:string::,D.B:string::,D.W<X>:string::->X=p;")[0]
EV_TARGET = parse_files("t=k:string:,A:string:,B:string:;")[0]
W_TARGET = parse_files("w=k:string:,p:string:,W:string:,A:string:;")[0]


@pytest.mark.parametrize(("text", "target"), [("select D.A,D.B from e", EV_TARGET), ("select D.W<X> from e where D.A != 'off'", W_TARGET)])
def test_incremental_is_full(spark, text, target):
    data = cells(spark, [
        ("1", "A", "a1", 1), ("1", "B", "b1", 1), ("1", "W1", "w1", 1), ("1", "W2", "w2", 1), ("2", "A", "on", 1), ("2", "W1", "v1", 1), ("3", "A", "a3", 1), ("3", "W1", "u", 1), ("4", "A", "a4", 1), ("4", "B", "b4", 1),
        ("1", "A", "a2", 11), ("1", "W2", "w9", 12), ("2", "A", "off", 13), ("3", "", None, 14, "delete_family"), ("3", "B", "again", 15), ("4", "B", None, 16, "delete_column"), ("5", "A", "new", 17), ("5", "W7", "x", 17), ("1", "W1", None, 18, "delete_column"), ("9", "A", "late", 99),
    ])
    before = engine.run(data, EV, text, target, None, 10)
    after = engine.run_incremental(data, before, EV, text, target, 10, 50)
    assert rows(after, *target_names(target)) == rows(engine.run(data, EV, text, target, None, 50), *target_names(target))


def target_names(target):
    return [F.coalesce(F.col(c.label), F.lit("-")) for c in target.columns]


def test_versions_hidden_by_markers(spark):
    data = cells(spark, [("k", "A", "old", 1), ("k", "A", "new", 2), ("k", "A", None, 2, "delete_version"), ("l", "A", "x", 1), ("l", "A", None, 3, "delete_column"), ("m", "A", "x", 5), ("m", "", None, 4, "delete_family")])
    assert rows(scans.live(data), F.decode("row_key", "UTF-8"), F.decode("value", "UTF-8")) == [("k", "old"), ("m", "x")]
    assert rows(scans.in_time(data, 2, 3), "ts") == [(2,), (2,)]


def test_sinks(spark, tmp_path):
    data = spark.createDataFrame([("a", "1"), ("b", None)], "k string, v string")
    files = DelimitedFiles(str(tmp_path), "sch", "app", "1")
    files.write(data)
    files.delete(data.select("k"), data.select("k", "v"))
    assert files.path.endswith("/sch/app/1")
    assert rows(DelimitedFiles.read(spark, f"{files.path}/insert", ["k", "v"]), "k", "v") == [("a", "1"), ("b", "NULL")]
    assert to_records(data).count() == 2
    target = parse_tables("tt=dbx->k:string:,v:int:,PARTITION=p:string:,STORAGE=PARQUET;")[0]
    table = ManagedTable(target, ["k"])
    table.write(spark.createDataFrame([("a", "1", "x"), ("b", "2", "y"), ("c", "3", "y")], "k string, v string, p string"))
    table.delete(spark.createDataFrame([("b",)], "k string"), spark.createDataFrame([], "k string"))
    assert rows(spark.table("dbx.tt"), "k", "v", "p") == [("a", 1, "x"), ("c", 3, "y")]
    assert "LOAD_TIMESTAMP" in spark.table("dbx.tt").columns and "LEFT ANTI JOIN" in load_script(target, "src", "del", ["k"])
    tall = parse_sources('c:c->RK=#:k#code="7"->F.v:string:"none":;')[0]
    cell = CellTable(str(tmp_path / "cells"), tall, 5)
    cell.write(data)
    cell.delete(spark.createDataFrame([("a",)], "k string"), spark.createDataFrame([], "k string"))
    left = scans.live(scans.scan(spark, cell.path))
    assert rows(left, F.decode("row_key", "UTF-8"), F.decode("value", "UTF-8")) == [("b#7", "none")]
    again = CellTable(str(tmp_path / "cells"), tall, 5)  # a later run begins after what is stored
    again.delete(spark.createDataFrame([("b",)], "k string"), spark.createDataFrame([], "k string"))
    again.write(data.filter("k = 'b'"))
    assert rows(scans.live(scans.scan(spark, cell.path)), F.decode("row_key", "UTF-8"), F.decode("value", "UTF-8")) == [("b#7", "none")]
    with pytest.raises(AnalysisError, match="no key field"):
        again.delete(spark.createDataFrame([("b",)], "other string"), spark.createDataFrame([], "k string"))


def test_jobs(spark, tmp_path):
    data = cells(spark, [("1", "A", "a1", 1), ("1", "B", "b1", 1), ("2", "A", "a2", 2)])
    catalog = Catalog().add(EV, EV_TARGET, parse_files("u=k:string:,A:string:;")[0])
    marks = Bookmarks(spark, str(tmp_path / "marks"))
    sinks = {}

    def sink(job):
        return sinks.setdefault(job.target, DelimitedFiles(str(tmp_path), job.target, "app", "1"))

    config = JobConfig("hdfs", "full", (Job("e", "t", "D.A,D.B", recon={"A": ["count"]}), Job("e", "u", "D.A")))
    reports = run_jobs(catalog, config, lambda _: data, sink, 10, marks)
    assert reports[0].recon == {"rows": 2, "count_A": 2} and marks.read("e", "t") == 10
    assert report_frame(spark, reports).count() == 3
    later = data.unionByName(cells(spark, [("2", "A", "a3", 12)]))
    run_jobs(catalog, JobConfig("hdfs", "incremental", (Job("e", "u", "D.A"),)), lambda _: later, sink, 20, marks)
    path = sinks["u"].path
    assert rows(DelimitedFiles.read(spark, f"{path}/insert", ["k", "A"]), "k", "A") == [("1", "a1"), ("2", "a2"), ("2", "a3")]
    assert rows(DelimitedFiles.read(spark, f"{path}/delete_all", ["k"]), "k") == [("2",)] and marks.read("e", "u") == 20


def test_schema_files(spark, tmp_path):
    for name, text in (("s", "e:e->RK=k->D.A:string::;\nf:f->RK=k->D.B:string::;"), ("f", "t=k:string:;"), ("t", "u=db->k:string:;")):
        (tmp_path / name).write_text(text)
    assert load_catalog(spark, [str(tmp_path / "s")], [str(tmp_path / "f")], [str(tmp_path / "t")]).list() == ["e", "f", "t", "u"]


def test_stream(spark, tmp_path):
    from tallspan.streaming.follow import follow

    first = cells(spark, [("1", "A", "a1", 1), ("2", "A", "a2", 2)])
    first.write.parquet(str(tmp_path / "in"))
    tall = parse_sources("o:o->RK=k->F.A:string::;")[0]
    sink = CellTable(str(tmp_path / "out"), tall, 100)
    sink.write(spark.createDataFrame([("2", "stale")], "k string, A string").filter("k = '9'"))
    target = parse_files("t3=k:string:,A:string:;")[0]
    follow(spark.readStream.schema(scans.SCHEMA).parquet(str(tmp_path / "in")), lambda: scans.scan(spark, str(tmp_path / "in")), EV, "select D.A from e", target, sink, str(tmp_path / "cp")).awaitTermination()
    assert rows(scans.latest(scans.scan(spark, sink.path)), F.decode("row_key", "UTF-8"), F.decode("value", "UTF-8")) == [("1", "a1"), ("2", "a2")]
    # A second batch: what it touched is replaced, also the markers' way, and a deleted row goes.
    cells(spark, [("1", "A", "new", 9), ("2", "A", "", 9, "delete_column")]).write.mode("append").parquet(str(tmp_path / "in"))
    follow(spark.readStream.schema(scans.SCHEMA).parquet(str(tmp_path / "in")), lambda: scans.scan(spark, str(tmp_path / "in")), EV, "select D.A from e", target, sink, str(tmp_path / "cp")).awaitTermination()
    assert rows(scans.live(scans.scan(spark, sink.path)), F.decode("row_key", "UTF-8"), F.decode("value", "UTF-8")) == [("1", "new")]


def test_partial_load_keeps_deletes(spark):
    """A cell put and then deleted inside the time range stays deleted; one deleted before it is as it was put."""
    data = cells(spark, [("1", "A", "gone", 5), ("1", "A", "", 7, "delete_column"), ("1", "B", "b", 5), ("2", "A", "a", 6), ("2", "A", "", 3, "delete_column")])
    out = engine.run(data, EV, "select D.A,D.B from e", EV_TARGET, 0, 10)
    assert rows(out, "k", "A", "B") == rows(engine.run(data, EV, "select D.A,D.B from e", EV_TARGET), "k", "A", "B") == [("1", None, "b"), ("2", "a", None)]


def test_marker_counts_before_a_put_of_its_time(spark):
    from tallspan.operators.cdc import changed_cells
    from tallspan.plans.engine import plan_of

    data = cells(spark, [("1", "A", "x", 2), ("1", "A", "", 2, "delete_version"), ("2", "A", "y", 2)])
    got = changed_cells(data, plan_of(EV, "select D.A from e"), 3)
    assert rows(got, F.decode("row_key", "UTF-8")) == [("1",)]
