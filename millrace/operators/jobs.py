"""Jobs that make several tables from files: published together, resumed where they stopped, skipped when nothing changed.

A job has a folder: ``runs/<fingerprint>/<table>`` with a mark ``<table>.json`` for each table that is whole, and ``manifest.json``,
which names the run that readers see.  The manifest is replaced by one rename when all tables of a run are there.
All access goes through Hadoop's file systems, so any store that Spark writes will do.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.shared import discarding

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Stage:
    """``make`` gets the tables of the stages before and returns its own, ``tables`` by name."""

    name: str
    tables: tuple[str, ...]
    make: Callable[[Tables], Tables]


class Folder:
    """Small files and folders under a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway, self.conf, self.path = spark._jvm, spark.sparkContext._gateway, spark._jsc.hadoopConfiguration(), path
        self.fs = self._at("").getFileSystem(self.conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def read(self, name: str) -> str | None:
        if not self.fs.exists(self._at(name)):
            return None
        stream = self.fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Under a name of its own first, then renamed: readers see the old text or the new."""
        made = f"{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self._at(made), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        kind = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.conf).rename(self.fs.makeQualified(self._at(made)), self.fs.makeQualified(self._at(name)), how)

    def names(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._at(name))) if self.fs.exists(self._at(name)) else []

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


def fingerprint(spark: SparkSession, sources: dict[str, str], version: str = "") -> str:
    """Names, sizes and times of all files under the paths, and ``version``, digested; files that begin with ``_`` or ``.`` don't count.

    Only the listing is read.
    """
    found = [version]
    for name, path in sorted(sources.items()):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(at, True)
        mine = []
        while files.hasNext():
            s = files.next()
            if not s.getPath().getName().startswith(("_", ".")):
                mine.append(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}")
        found += [name, *sorted(mine)]
    return hashlib.sha256("\n".join(found).encode()).hexdigest()[:32]


def write_observed(df: DataFrame, path: str, key: list[str]) -> dict:
    """Distinct rows, sorted by key, as Parquet; rows and a digest of them are counted as they are written, without another pass.

    Rows that are equal lie in one range of the key, so the ranges of the sort serve the search for them, too: rows move once.
    """
    seen = Observation()
    digest = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).cast("string")
    df.repartitionByRange(*key).distinct().sortWithinPartitions(*key).observe(seen, F.count(F.lit(1)).alias("rows"), digest.alias("digest")).write.mode("overwrite").parquet(path)
    return {"rows": seen.get["rows"], "digest": seen.get["digest"] or "0"}


def run_job(spark: SparkSession, folder: str, sources: dict[str, str], stages: list[Stage], keys: dict[str, list[str]], version: str = "") -> dict:
    """Make all tables of the stages, unless the folder has them from the same sources; returns the manifest.

    The manifest has the run's ``fingerprint``, and ``rows`` and ``digest`` of each table.  Where it is of these sources, nothing
    else is read.  A run that was ended goes on at the first table without its mark; a stage whose tables are all there
    isn't called again.  Intermediate tables of a stage are deleted when its tables are written.  Readers see the tables of the last whole run until the next one is; then the old run is deleted.  One job at a
    time may write a folder.
    """
    home, now = Folder(spark, folder), fingerprint(spark, sources, version)
    manifest = json.loads(home.read("manifest.json") or "{}")
    if manifest.get("fingerprint") == now:
        return manifest
    run, done = f"runs/{now}", {}
    tables: Tables = {}
    for stage in stages:
        marks = {name: home.read(f"{run}/{name}.json") for name in stage.tables}
        with discarding(spark):
            made = stage.make(dict(tables)) if None in marks.values() else {}
            for name in stage.tables:
                path = f"{folder}/{run}/{name}"
                if marks[name] is None:
                    marks[name] = json.dumps(write_observed(made[name], path, keys.get(name) or made[name].columns))
                    home.write(f"{run}/{name}.json", marks[name])
                done[name] = json.loads(marks[name])
                tables[name] = spark.read.parquet(path)
    manifest = {"fingerprint": now, "tables": done}
    home.write("manifest.json", json.dumps(manifest))
    for old in home.names("runs"):
        if old != now:
            home.delete(f"runs/{old}")
    return manifest


def read_job(spark: SparkSession, folder: str) -> Tables:
    """The published tables of a job."""
    manifest = json.loads(Folder(spark, folder).read("manifest.json") or "null")
    if manifest is None:
        raise FileNotFoundError(f"no finished job in {folder}")
    return {name: spark.read.parquet(f"{folder}/runs/{manifest['fingerprint']}/{name}") for name in manifest["tables"]}


def job_report(spark: SparkSession, folder: str) -> DataFrame:
    """``(table, rule, severity, rows)`` of the published run: rows of each table (no rule), and what its quarantine tables hold by rule.

    The rows of tables come from the manifest; only tables whose names begin with ``quarantine`` are read.
    """
    tables = json.loads(Folder(spark, folder).read("manifest.json") or '{"tables": {}}')["tables"]
    out = spark.createDataFrame([(name, None, None, t["rows"]) for name, t in tables.items()], "table string, rule string, severity string, rows long")
    for name, df in read_job(spark, folder).items() if tables else ():
        if name.startswith("quarantine"):
            out = out.unionByName(df.groupBy("table", "rule", "severity").agg(F.count("*").alias("rows")))
    return out
