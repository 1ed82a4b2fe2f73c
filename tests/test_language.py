"""Schema texts, query texts, and what must agree between them."""

import pytest

from tallspan.catalog import Catalog, parse_files, parse_sources, parse_tables
from tallspan.errors import AnalysisError, ConfigError, QueryError, SchemaError
from tallspan.plans.analyzer import analyze, validate
from tallspan.plans.job import Job, JobConfig, SystemConfig, job_config, system_config
from tallspan.plans.query import conditions, parse
from tallspan.shell import answer

WIDE = 'w:w->RK=|:hash(rt)[0:6]|fp|rt|code="07"->D.SR1:string:"Y":,D.TAX:int::,D.AT:date(dd/MM/yyyy)::,D.J<X>:json::snappy,D.RC<X>:string::,<X>.DTL:string::->X=|:prov|SKIP|inum;'


def source():
    return parse_sources(WIDE.replace("<X>.DTL", "D.<X>DTL"))[0]


def test_source_text():
    s = source()
    assert s.key_names == ("fp", "rt") and s.salt_bytes == 1 and s.wide
    assert s.part_names == ("prov", "inum")
    assert s.column("D", "AT").date_format == "dd/MM/yyyy" and s.column("D", "SR1").default == "Y"
    assert s.column("D", "DTL").suffix == "DTL" and s.column(None, "J").codec == "snappy"


@pytest.mark.parametrize("text", ["w:w->RK=a->D.a:string::;", "w:w->RK=|:hash(a)[7:0]|b->D.c:string::;", "w:w->RK=a->D.c:int(dd-MM-yyyy)::;", "w:w->RK=a->D.c:string::", "w->RK=a->D.c:string::;", "w:w->RK=a->D.c:string::lzo;"])
def test_bad_source_text(text):
    with pytest.raises(SchemaError):
        parse_sources(text)


def test_target_texts():
    f = parse_files('t=a:string:"x",PARENT=p#q>COLUMNS=JSON.r:decimal:,JSON.4::;')[0]
    assert [c.label for c in f.columns] == ["a", "p#q#r", "p#q#4"]
    t = parse_tables("t=db->a:string:,b:date:,PARTITION=c:int:,STORAGE=ORC;")[0]
    assert (t.database, t.storage, [c.label for c in t.partitions]) == ("db", "orc", ["c"])
    for bad in ("t=a:string:,a:int:;", "t=PARENT=p>COLUMNS=a:string:;"):
        with pytest.raises(SchemaError):
            parse_files(bad)
    with pytest.raises(SchemaError):
        parse_tables("t=db->a:string:,STORAGE=tape;")


def test_catalog_and_shell():
    c = Catalog().add(source(), *parse_files("t=a:string:;"))
    with pytest.raises(SchemaError):
        c.add(source())
    with pytest.raises(SchemaError):
        c.target("w")
    assert answer(c, "list") == "t\nw" and answer(c, "show schema t") == "t=a:string:;" and answer(c, "exit") is None
    assert "not declared" in answer(c, "show schema z") and answer(c, "?").startswith("list")


def test_no_precedence():
    where = parse("select a from t where a = 'x' AND b = 'y' OR c = 'z'").where
    assert where.op == "and" and where.right.op == "or"
    where = parse("select a from t where (a = 'x' AND b = 'y') OR c = 'z'").where
    assert where.op == "or" and where.left.op == "and"


def test_values():
    q = parse("select D.a,b#c from t where a = \"say \"\"x\"\"\" and n > 100 and r NOT REGEXP '[a-z]+'")
    assert [c.value for c in conditions(q.where)] == ['say "x"', "100", "[a-z]+"]
    assert q.select[1].json


@pytest.mark.parametrize("text", ["select a from", "select a from t where", "select a from t where a = 'x' and and b = 'y'", "select a from t x", "select a from t where a ~ 'x'", "select a from t where (a = 'x'"])
def test_bad_queries(text):
    with pytest.raises(QueryError):
        parse(text)


@pytest.mark.parametrize("where", ["nix = 'a'", "D.SR1 > 'a'", "rt < '1'", "prov >= '1'", "D.Z<X> = '1'"])
def test_bad_conditions(where):
    with pytest.raises(AnalysisError):
        analyze(source(), parse(f"select D.RC<X> from w where {where}"))


def test_select():
    s = source()
    assert {c.name for c in analyze(s, parse("select D.* from w")).select} == {"SR1", "TAX", "AT", "J", "RC", "DTL"}
    assert analyze(s, parse("select fp from w")).key_only
    with pytest.raises(AnalysisError):
        analyze(s, parse("select D.nix from w"))


@pytest.mark.parametrize(
    ("select", "columns", "message"),
    [
        ("D.RC<X>", "fp,rt,prov,inum,RC,nope", "not in the source"),
        ("D.RC<X>,D.TAX", "fp,rt,prov,inum,RC,TAX", "either fixed"),
        ("D.RC<X>", "fp,rt,prov,inum", "not in the target"),
        ("D.TAX", "fp,rt,TAX,SR1", "neither selected"),
        ("D.RC<X>", "fp,rt,RC", "lacks the key columns"),
    ],
)
def test_load_rules(select, columns, message):
    target = parse_files("t=" + ",".join(f"{c}:string:" for c in columns.split(",")) + ";")[0]
    with pytest.raises(AnalysisError, match=message):
        validate(analyze(source(), parse(f"select {select} from w"), target), target)


def test_json_rule():
    target = parse_files("t=fp:string:,rt:string:,prov:string:,inum:string:,PARENT=a>COLUMNS=JSON.b::;")[0]
    validate(analyze(source(), parse("select D.J<X> from w"), target), target)
    with pytest.raises(AnalysisError, match="exactly one JSON"):
        validate(analyze(source(), parse("select D.RC<X> from w"), target), target)


def test_instantiated_dynamic():
    one = parse_sources("o:o->RK=k->D.A<X>:string::->X=p;")[0]
    plan = analyze(one, parse("select D.A<X> from o where p = '7'"))
    assert plan.instantiated(plan.select[0]) == "A7"
    assert analyze(one, parse("select D.A<X> from o where p = '7' or k = '1'")).instantiated(plan.select[0]) is None


def test_configs():
    c = job_config("<jobConfig><target>hdfs</target><loadType>partial</loadType><minTimeStamp>5</minTimeStamp><jobs><job><selectColumns>D.a</selectColumns><sourceSchemaName>s</sourceSchemaName><targetSchemaName>t</targetSchemaName><conditions>a = 'x'</conditions><reconList><recon><reconColumn>a</reconColumn><reconOperation>COUNT</reconOperation></recon></reconList></job></jobs></jobConfig>")
    assert c.low == 5 and c.jobs[0].recon == {"a": ["COUNT"]} and c.jobs[0].query == "select D.a from s where a = 'x'"
    s = system_config("<s><spark.dynamicAllocation.minExecutors>2</spark.dynamicAllocation.minExecutors><numberOfPartitions>3</numberOfPartitions><hdfsTargetProperties><destHdfsUrl>hdfs://n/</destHdfsUrl><hdfsBasePath>/p</hdfsBasePath></hdfsTargetProperties></s>")
    assert s.partitions == 3 and s.base_path == "hdfs://n/p" and s.spark_conf()["spark.dynamicAllocation.enabled"] == "true"
    for bad in (dict(target="tape", load="full"), dict(target="hive", load="some"), dict(target="hive", load="partial"), dict(target="hive", load="full", low=3, high=2)):
        with pytest.raises(ConfigError):
            JobConfig(jobs=(Job("s", "t", "a"),), **bad)
    with pytest.raises(ConfigError):
        SystemConfig({"spark.dynamicAllocation.minExecutors": "9", "spark.dynamicAllocation.maxExecutors": "2"})
