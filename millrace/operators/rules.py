"""Validation of tables by rules: valid rows on, broken ones to one quarantine table.

Rules on rows are columns of the same pass; all rules with one key share one aggregation of minima and maxima, which combines
before its shuffle, so a hot key costs its task one row from each other task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.shared import stored

SEVERITIES = ("fail", "reject", "warn")
#: ``row`` is the broken row as JSON; warnings about a key list the key alone, without its rows.
QUARANTINE = "table string, key string, rule string, severity string, row string"


class BrokenRules(ValueError):
    """Rows that break a rule of severity ``fail``."""


@dataclass(frozen=True)
class Row:
    """``ok`` holds for good rows; null counts as no."""

    name: str
    ok: Column
    severity: str = "reject"


@dataclass(frozen=True)
class Key:
    """Each key has one combination of ``one``; without ``one``, one row.  Rows with a null in the key are not compared."""

    name: str
    key: tuple[str, ...]
    one: tuple[str, ...] = ()
    severity: str = "reject"


@dataclass
class Quarantine:
    """The broken rows of a job's tables, and how severe each rule is where that differs from its default."""

    severity: dict[str, str] = field(default_factory=dict)
    parts: list[DataFrame] = field(default_factory=list)

    def __post_init__(self):
        if bad := set(self.severity.values()) - set(SEVERITIES):
            raise ValueError(f"no such severity: {sorted(bad)}")

    def of(self, rule: Row | Key) -> str:
        return self.severity.get(rule.name, rule.severity)

    def put(self, df: DataFrame, table: str, rule: str, key: Sequence[str], severity: str = "reject") -> None:
        """All rows of ``df`` break ``rule``; where its severity is ``fail``, one row raises."""
        severity = self.severity.get(rule, severity)
        rows = df.select(F.lit(table).alias("table"), _shown(key), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.to_json(F.struct(*df.columns)).alias("row"))
        if severity == "fail" and (first := rows.first()):
            raise BrokenRules(f"{table}: {rule}: {first['key']}")
        self.parts.append(rows)

    def check(self, df: DataFrame, table: str, key: Sequence[str], rules: Sequence[Row | Key]) -> DataFrame:
        """The valid rows of ``df``, which is written with what each row breaks; broken rows are put aside.

        A row that breaks several rules has an entry for each.  ``fail`` raises ``BrokenRules`` with the number of broken rows
        by rule.  Rows with warnings only are valid.
        """
        rows, keys = [r for r in rules if isinstance(r, Row)], [r for r in rules if isinstance(r, Key)]
        kind = "array<struct<rule: string, severity: string, listed: boolean>>"
        entry = lambda r, listed: F.struct(F.lit(r.name).alias("rule"), F.lit(self.of(r)).alias("severity"), F.lit(listed).alias("listed"))
        broken = F.array_compact(F.array(*[F.when(~F.coalesce(r.ok, F.lit(False)), entry(r, True)) for r in rows])) if rows else F.array()
        out = df.withColumn("_broken", broken.cast(kind))
        for cols in dict.fromkeys(r.key for r in keys):
            mine = [r for r in keys if r.key == cols]
            bad = [F.count("*") > 1 if not r.one else F.min(F.struct(*r.one)) != F.max(F.struct(*r.one)) for r in mine]
            named = {c: f"_key{i}" for i, c in enumerate(cols)}
            found = df.dropna(subset=list(cols)).groupBy(*[F.col(c).alias(n) for c, n in named.items()]).agg(F.array_compact(F.array(*[F.when(b, entry(r, self.of(r) != "warn")) for b, r in zip(bad, mine)])).cast(kind).alias("_more")).filter("size(_more) > 0")
            found = stored(found, f"keys-{table}")
            if warned := [r for r in mine if self.of(r) == "warn"]:
                of_key = found.select(*[F.col(n).alias(c) for c, n in named.items()], F.explode("_more").alias("e")).filter(F.col("e.rule").isin(*[r.name for r in warned]))
                self.parts.append(of_key.select(F.lit(table).alias("table"), _shown(cols), F.col("e.rule").alias("rule"), F.col("e.severity").alias("severity"), F.lit(None).cast("string").alias("row")))
            heavy = found.withColumn("_more", F.filter("_more", lambda e: e["listed"])).filter("size(_more) > 0")
            on = [F.col(c) == F.col(n) for c, n in named.items()]
            out = out.join(heavy, on, "left").withColumn("_broken", F.concat("_broken", F.coalesce("_more", F.array().cast(kind)))).drop("_more", *named.values())
        out = stored(out, f"checked-{table}")
        each = out.filter("size(_broken) > 0").select("*", F.explode("_broken").alias("_e"))
        failed = [r.name for r in rules if self.of(r) == "fail"]
        if failed and (counts := each.filter(F.col("_e.rule").isin(*failed)).groupBy("_e.rule").count().collect()):
            raise BrokenRules(f"{table}: " + ", ".join(f"{r['rule']}: {r['count']}" for r in sorted(counts)))
        self.parts.append(each.select(F.lit(table).alias("table"), _shown(key), F.col("_e.rule").alias("rule"), F.col("_e.severity").alias("severity"), F.to_json(F.struct(*df.columns)).alias("row")))
        return out.filter("NOT exists(_broken, e -> e.severity != 'warn')").drop("_broken")

    def table(self, df: DataFrame) -> DataFrame:
        """All that was put aside; ``df`` gives the session."""
        out = df.sparkSession.createDataFrame([], QUARANTINE)
        for part in self.parts:
            out = out.unionByName(part)
        return out


def _shown(key: Sequence[str]) -> Column:
    """Parts of a key as text, joined by ``/``; nulls are empty."""
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]).alias("key")
