"""Tables of a database that change together.

A change writes the new rows of each table as partitions of its own run beside the published ones, and
nothing that readers see is touched. Publishing then adds one partition to the table ``published``: which
(partition, run) pairs make up every table from now on. That single step moves all tables at once; a job
that is lost before it leaves everything as it was, and its rows are dropped by the next change. The named
tables are views over the newest list, so a query sees one state of all tables. The list before the newest stays
readable, for queries that are still running; what neither list names is dropped.

One change at a time: writers of the same database have to be kept apart by whoever schedules them.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

PUBLISHED, KEPT = "published", 2
LISTED = "table_name string, by string, part string, run string, version long"

# The date column that a table is stored by, its value (both None for a table without), and the run that wrote it.
Part = tuple[str | None, str | None, str]


@dataclass(frozen=True)
class Versions:
    """The published state of the tables of one database."""

    spark: SparkSession
    database: str

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def stored(self, table: str) -> str:
        """The table that holds the rows of all runs."""
        return f"{self.database}.{table}_runs"

    def newest(self) -> int:
        """The number of the published state, 0 before the first."""
        return max(self._numbers(), default=0)

    def _numbers(self) -> list[int]:
        name = self.name(PUBLISHED)
        if not self.spark.catalog.tableExists(name):
            return []
        return [int(row[0].split("=")[1]) for row in self.spark.sql(f"SHOW PARTITIONS {name}").collect()]

    def parts(self, version: int | None = None) -> dict[str, list[Part]]:
        """The partitions of every table: as many entries as there are tables and dates."""
        version = self.newest() if version is None else version
        out: dict[str, list[Part]] = defaultdict(list)
        if version:
            for row in self.spark.table(self.name(PUBLISHED)).where(F.col("version") == version).collect():
                out[row["table_name"]].append((row["by"], row["part"], row["run"]))
        return out

    def read(self, table: str, parts: list[Part] | None = None) -> DataFrame:
        """A table's rows in the given partitions, by default the published ones; no other partition is read."""
        parts = self.parts()[table] if parts is None else parts
        runs: dict[str, list[Part]] = defaultdict(list)
        for part in parts:
            runs[part[2]].append(part)
        wanted = F.lit(False)
        for run, mine in runs.items():
            by = mine[0][0]
            known = F.col(by).isin([F.lit(p).cast("date") for _, p, _ in mine if p is not None]) if by else F.lit(True)
            blank = F.col(by).isNull() if by and any(p is None for _, p, _ in mine) else F.lit(False)
            wanted = wanted | ((F.col("run") == run) & (known | blank))
        return self.spark.table(self.stored(table)).where(wanted).drop("run")

    def begin(self) -> Change:
        number = self.newest()
        before = self.parts(number)
        return Change(self, f"r{uuid.uuid4().hex}", number, before, dict(before))


@dataclass
class Change:
    """New rows of some tables, not visible until they are published together."""

    versions: Versions
    run: str
    number: int  # of the state that it starts from
    before: dict[str, list[Part]]
    parts: dict[str, list[Part]]
    comments: dict[str, str] = field(default_factory=dict)
    dates: dict[str, str] = field(default_factory=dict)  # the date columns of the tables written

    def write(
        self, rows: DataFrame, table: str, by: str | None = None, *,
        keep: Callable[[str | None], bool] | None = None, fmt: str = "parquet", comment: str | None = None,
        watch: Callable[[DataFrame], DataFrame] | None = None, gather: bool = True,
    ) -> None:
        """``rows`` take the place of a table's rows, but for published partitions that ``keep`` holds for.

        With ``by`` they are stored by that date; the rebalance gathers a date in as few files as its size allows and
        lets AQE split one that is too large for a task. A date among ``rows`` is always theirs alone.
        Without ``gather`` they are not shuffled for that: every task writes the dates it has, for rows that all have one
        date, or too many of them to ship once more.
        ``watch`` is applied in the writing stage. Parquet and ORC files are written with zstd.
        """
        shaped = rows.hint("rebalance", by) if by and gather else rows
        shaped = watch(shaped) if watch else shaped
        packing = {"compression": "zstd"} if fmt in ("parquet", "orc") else {}
        (shaped.withColumn("run", F.lit(self.run)).write.format(fmt).options(**packing).mode("append")
         .partitionBy(*([by] if by else []), "run").saveAsTable(self.versions.stored(table)))
        new = [p for p in _partitions(self.versions, table, by) if p[2] == self.run] if by else [(None, None, self.run)]
        dates = {part for _, part, _ in new} if by else set()
        if by:
            self.dates[table] = by
        self.parts[table] = [p for p in self.parts.get(table, []) if keep and keep(p[1]) and p[1] not in dates] + new
        if comment:
            self.comments[table] = comment

    def read(self, table: str) -> DataFrame:
        """A table as it will be."""
        return self.versions.read(table, self.parts.get(table, []))

    def publish(self) -> None:
        """Makes all that was written visible at once, then drops what no kept state names."""
        spark, versions, number = self.versions.spark, self.versions, self.number + 1
        lines = [(table, *part, number) for table, parts in self.parts.items() for part in parts]
        (spark.createDataFrame(lines, LISTED).coalesce(1).write.mode("append").partitionBy("version")
         .saveAsTable(versions.name(PUBLISHED)))
        self._views()
        self._drop_unnamed(number)

    def _views(self) -> None:
        """The tables' names, once: what they show follows from the newest list."""
        spark, versions = self.versions.spark, self.versions
        listed = versions.name(PUBLISHED)
        for table in self.parts:
            if spark.catalog.tableExists(versions.name(table)):
                continue
            columns = ", ".join(f"r.`{c}`" for c in spark.table(versions.stored(table)).columns if c != "run")
            by = self.dates.get(table)
            same = f" AND p.part <=> CAST(r.`{by}` AS STRING)" if by else ""
            text = self.comments.get(table, "").replace("\\", "\\\\").replace("'", "\\'")
            comment = f" COMMENT '{text}'" if text else ""
            spark.sql(
                f"CREATE VIEW {versions.name(table)}{comment} AS SELECT {columns} FROM {versions.stored(table)} r "
                f"LEFT SEMI JOIN (SELECT * FROM {listed} WHERE version = (SELECT MAX(version) FROM {listed})) p "
                f"ON p.table_name = '{table}' AND p.run = r.run{same}")

    def _drop_unnamed(self, newest: int) -> None:
        """Drops the partitions that neither this state names nor the one it started from, lost runs' among them."""
        spark, versions = self.versions.spark, self.versions
        for table, parts in self.parts.items():
            old = self.before.get(table, [])
            if parts == old:
                continue
            by = self.dates.get(table) or next((b for b, _, _ in (*parts, *old)), None)
            gone = [p for p in _partitions(versions, table, by) if p not in {*parts, *old}]
            _drop(spark, versions.stored(table), [
                (f"{b}=" + ("null" if part is None else f"DATE'{part}'") + ", " if b else "") + f"run='{run}'" for b, part, run in gone])
        _drop(spark, versions.name(PUBLISHED), [f"version={n}" for n in versions._numbers() if n <= newest - KEPT])


def _drop(spark: SparkSession, table: str, specs: list[str]) -> None:
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({s})" for s in specs))


def _partitions(versions: Versions, table: str, by: str | None) -> list[Part]:
    """The stored partitions of all runs, from the catalog."""
    out = []
    for row in versions.spark.sql(f"SHOW PARTITIONS {versions.stored(table)}").collect():
        values = dict(p.split("=", 1) for p in row[0].split("/"))
        run = values.pop("run")
        part = next(iter(values.values()), None)
        out.append((by, None if part in ("null", "__HIVE_DEFAULT_PARTITION__") else part, run))
    return out
