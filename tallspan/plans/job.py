"""Configured loads: several queries over stored cells, each with its sink, bookmark and reconciliation."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..catalog import Catalog, parse_files, parse_sources, parse_tables
from ..errors import ConfigError
from ..operators.recon import observed, validate_recon
from ..sources.bookmarks import Bookmarks
from ..sources.sinks import Sink
from .engine import delete_rows, incremental, plan_of, run

TARGETS, LOADS = ("hive", "hdfs", "hbase"), ("full", "partial", "incremental")


@dataclass(frozen=True)
class Job:
    source: str
    target: str
    select: str
    conditions: str = ""
    recon: dict[str, list[str]] = field(default_factory=dict)

    @property
    def query(self) -> str:
        return f"select {self.select} from {self.source}" + (f" where {self.conditions}" if self.conditions.strip() else "")


@dataclass(frozen=True)
class JobConfig:
    target: str
    load: str
    jobs: tuple[Job, ...]
    low: int | None = None
    high: int | None = None

    def __post_init__(self) -> None:
        if self.target.lower() not in TARGETS:
            raise ConfigError(f"target {self.target} is not one of {', '.join(TARGETS)}")
        if self.load.lower() not in LOADS:
            raise ConfigError(f"load type {self.load} is not one of {', '.join(LOADS)}")
        if not self.jobs:
            raise ConfigError("no jobs")
        if self.load.lower() == "partial" and self.low is None and self.high is None:
            raise ConfigError("a partial load needs a time bound")
        if self.low is not None and self.high is not None and self.low >= self.high:
            raise ConfigError("the lower time bound must be below the upper one")
        for j in self.jobs:
            if not (j.source and j.target and j.select):
                raise ConfigError("a job needs a source, a target and a select")


@dataclass(frozen=True)
class SystemConfig:
    spark: dict[str, str] = field(default_factory=dict)
    partitions: int | None = None
    parallel: bool = True
    base_path: str | None = None
    bookmark_path: str | None = None

    def __post_init__(self) -> None:
        if self.partitions is not None and self.partitions < 1:
            raise ConfigError("the number of partitions must be positive")
        counts = [int(self.spark[k]) for k in (f"spark.dynamicAllocation.{x}Executors" for x in ("min", "initial", "max")) if k in self.spark]
        if counts != sorted(counts):
            raise ConfigError("executors must be min <= initial <= max")

    def session(self) -> SparkSession:
        builder = SparkSession.builder
        for k, v in self.spark_conf().items():
            builder = builder.config(k, v)
        return builder.getOrCreate()

    def spark_conf(self) -> dict[str, str]:
        out = dict(self.spark)
        if any(k.startswith("spark.dynamicAllocation.") for k in out):
            out.setdefault("spark.dynamicAllocation.enabled", "true")
            out.setdefault("spark.dynamicAllocation.shuffleTracking.enabled", "true")
        return out


def _text(node: ET.Element, name: str) -> str | None:
    value = node.findtext(name)
    return value.strip() if value and value.strip() else None


def job_config(xml: str) -> JobConfig:
    root = ET.fromstring(xml)
    jobs = []
    for j in root.iterfind("jobs/job"):
        ops: dict[str, list[str]] = {}
        for r in j.iterfind("reconList/recon"):
            ops.setdefault(_text(r, "reconColumn") or "", []).append(_text(r, "reconOperation") or "")
        jobs.append(Job(_text(j, "sourceSchemaName") or "", _text(j, "targetSchemaName") or "", _text(j, "selectColumns") or "", _text(j, "conditions") or "", ops))
    stamp = lambda name: int(v) if (v := _text(root, name)) else None
    return JobConfig(_text(root, "target") or "", _text(root, "loadType") or "", tuple(jobs), stamp("minTimeStamp"), stamp("maxTimeStamp"))


def system_config(xml: str) -> SystemConfig:
    root = ET.fromstring(xml)
    spark = {n.tag: n.text.strip() for n in root if n.tag.startswith("spark.") and n.text and n.text.strip()}
    n = _text(root, "numberOfPartitions")
    props, marks = root.find("hdfsTargetProperties"), root.find("timestampTable")
    base = None if props is None else "/".join(x.strip("/") if i else x.rstrip("/") for i, x in enumerate(filter(None, (_text(props, "destHdfsUrl"), _text(props, "hdfsBasePath")))))
    return SystemConfig(spark, int(n) if n else None, (_text(root, "runJobsParallelly") or "true").lower() == "true", base, None if marks is None else _text(marks, "tableName"))


def read_text(spark: SparkSession, path: str) -> str:
    """A schema or configuration file from any store that Spark reads."""
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def load_catalog(spark: SparkSession, sources: list[str] = (), files: list[str] = (), tables: list[str] = ()) -> Catalog:
    out = Catalog()
    for paths, parse in ((sources, parse_sources), (files, parse_files), (tables, parse_tables)):
        for p in paths:
            out.add(*parse(read_text(spark, p)))
    return out


@dataclass(frozen=True)
class Report:
    """What a job did; recon is empty for incremental loads."""

    source: str
    target: str
    load: str
    recon: dict


def run_jobs(catalog: Catalog, config: JobConfig, cells: Callable[[str], DataFrame], sink: Callable[[Job], Sink], high: int, bookmarks: Bookmarks | None = None, parallel: bool = True) -> list[Report]:
    """All jobs, in threads of one session if parallel; a bookmark is set only after its job has written."""

    def one(job: Job) -> Report:
        spec, target, load = catalog.source(job.source), catalog.target(job.target), config.load.lower()
        validate_recon(target, job.recon)
        upper = config.high if config.high is not None else high
        mark = bookmarks.read(job.source, job.target) if bookmarks and load == "incremental" else None
        out = sink(job)
        if mark is not None:
            plan = plan_of(spec, job.query, target)
            found, rows = incremental(cells(spec.table), plan, target, mark, upper)
            out.delete(*delete_rows(found, plan))
            out.write(rows)
            seen = {}
        else:
            rows = run(cells(spec.table), spec, job.query, target, config.low if load == "partial" else None, upper)
            rows, observation = observed(rows, job.recon, f"recon_{job.target}")
            out.write(rows)
            seen = {} if load == "incremental" else observation.get
        if bookmarks and load != "partial":
            bookmarks.write(job.source, job.target, upper)
        return Report(job.source, job.target, load, seen)

    if not parallel or len(config.jobs) == 1:
        return [one(j) for j in config.jobs]
    with ThreadPoolExecutor(len(config.jobs)) as pool:
        return list(pool.map(one, config.jobs))


def report_frame(spark: SparkSession, reports: list[Report]) -> DataFrame:
    rows = [(r.source, r.target, r.load, k, str(v)) for r in reports for k, v in (r.recon or {"rows": ""}).items()]
    return spark.createDataFrame(rows, "source string, target string, load string, measure string, value string")
