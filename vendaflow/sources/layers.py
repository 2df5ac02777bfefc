"""A database published as a whole: one pointer says which batches of rows every table shows.

Rows of a table lie in one partitioned data table, `<table>__dados_<digest>`, in batches (`_lote`). The pointer is the view `_atual`, one
row with the batches of each table; the table's own name is a view that shows the batches the pointer lists. Publishing replaces
the pointer and nothing else, so readers see all tables of the run before or all of the new one, and a run that dies before leaves no
trace. Since the pointer is a constant, Spark folds it into the query and prunes partitions before it reads.

A batch is written once and may be listed by many runs: a table whose partitions did not change shares them with the run
before by reference.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaflow.sources.tables import append_batches

BATCH, POINTER = "_lote", "_atual"
#: Runs that the pointer remembers, this one included, and hours after which rows that none of them lists are dropped.
REMEMBERED, RETENTION_HOURS = 3, 24.0

_TABLES = "ARRAY<STRUCT<tabela: STRING, dados: STRING, lotes: ARRAY<STRING>>>"


class ConcurrentRun(Exception):
    """Another run has published the layer since this one began."""


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Layer:
    """One run over one database: `write` and `share` stage tables, `publish` shows them all at once."""

    def __init__(self, spark: SparkSession, database: str, run: str | None = None):
        self.spark, self.database = spark, database
        self.run = run or f"v{time.time_ns() // 1_000_000}x{uuid.uuid4().hex[:6]}"
        self.runs = self._remembered()
        self._staged: dict[str, tuple[str, list[str]]] = {}     # table: data table and batches
        self._notes: dict[str, str | None] = {}
        self._writes = 0

    # ---- the pointer ----------------------------------------------------------------------------

    def _remembered(self) -> list[tuple[str, dict[str, tuple[str, list[str]]]]]:
        """Published runs, the current one first: the name of the run, and data table and batches of each table."""
        name = f"{self.database}.{POINTER}"
        if not self.spark.catalog.databaseExists(self.database) or not self.spark.catalog.tableExists(name):
            return []
        rows = self.spark.table(name).select(F.explode("execucoes").alias("e")).select("e.*").collect()
        return [(r["execucao"], {t["tabela"]: (t["dados"], list(t["lotes"])) for t in r["tabelas"]}) for r in rows]

    @property
    def current(self) -> dict[str, tuple[str, list[str]]]:
        return self.runs[0][1] if self.runs else {}

    def _point(self, runs: list[tuple[str, dict[str, tuple[str, list[str]]]]]) -> None:
        def batches(names: list[str]) -> str:
            return "CAST(array({}) AS ARRAY<STRING>)".format(", ".join(map(_quoted, names)))

        def told_of(tables: dict[str, tuple[str, list[str]]]) -> str:
            return ", ".join(f"named_struct('tabela', {_quoted(t)}, 'dados', {_quoted(data)}, 'lotes', {batches(names)})" for t, (data, names) in sorted(tables.items()))

        shown = ", ".join(f"{_quoted(t)}, {batches(names)}" for t, (_, names) in sorted(runs[0][1].items()))
        told = ", ".join(f"named_struct('execucao', {_quoted(run)}, 'tabelas', CAST(array({told_of(tables)}) AS {_TABLES}))" for run, tables in runs)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{POINTER} AS SELECT "
                       f"CAST(map({shown}) AS MAP<STRING, ARRAY<STRING>>) AS atual, array({told}) AS execucoes")
        self.runs = runs

    # ---- staging --------------------------------------------------------------------------------

    def write(self, table: str, df: DataFrame, partition_by: list[str] | None = None, comment: str | None = None,
              shared: Iterable[str] = (), bucket_by: tuple[str, int] | None = None) -> int:
        """Stage `df` as new batches of `table`, beside the batches `shared` with earlier runs; returns the rows written.

        `bucket_by` (column, buckets) lays rows out for lookups: a query for one value reads one bucket, whose files are sorted by the
        column and carry a Bloom filter of it.

        A partitioned table has one batch per partition and run, so that a later run can share single partitions."""
        keys = partition_by or []
        data = self.data_table(table, df, [*keys, *map(str, bucket_by or ())])
        self._writes += 1
        prefix = f"{self.run}n{self._writes}"
        parts = [F.lit(prefix), *(F.coalesce(F.col(k).cast("string"), F.lit("nulo")) for k in keys)]
        written, rows = append_batches(df.withColumn(BATCH, F.concat_ws("-", *parts)), f"{self.database}.{data}", [BATCH, *keys], prefix, bucket_by)
        self._staged[table] = (data, [*shared, *written])
        self._notes[table] = comment
        return rows

    def data_table(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Where batches with the columns of `df` lie; rows can be shared with earlier runs only within one."""
        shape = "|".join([*(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields), *(partition_by or [])])
        return f"{table}__dados_{hashlib.md5(shape.encode()).hexdigest()[:8]}"

    def staged(self, table: str) -> list[str]:
        """Batches that the table will show once it is published."""
        return self._staged[table][1]

    def share(self, table: str, batches: Iterable[str] | None = None) -> None:
        """Show `batches` (default: all) of the published table again, without writing."""
        data, names = self.current[table]
        self._staged[table] = (data, names if batches is None else list(batches))

    def published(self, table: str) -> list[str]:
        """Batches that the published table shows; none if there is no such table."""
        return self.current.get(table, ("", []))[1]

    def has(self, table: str) -> bool:
        return table in self._staged or table in self.current

    def read(self, table: str, staged: bool = True) -> DataFrame:
        """Rows as this run has staged them, else (or without `staged`) as the layer shows them that was published when the run began."""
        if not self.has(table):                     # a plain table of the database
            return self.spark.table(f"{self.database}.{table}")
        data, names = (self._staged.get(table) if staged else None) or self.current[table]
        return self.spark.table(f"{self.database}.{data}").where(F.col(BATCH).isin(names)).drop(BATCH)

    # ---- publishing -----------------------------------------------------------------------------

    def publish(self, retention_hours: float = RETENTION_HOURS) -> None:
        """Show all staged tables; one change of the catalog. Tables that were not staged stay as they are.

        Refuses if another run has published since this one began. Views are made before the pointer moves: one of a new
        table has no rows until then. Only a table whose columns changed gets its new view afterwards."""
        if not self._staged:
            return
        if [name for name, _ in self._remembered()][:1] != [name for name, _ in self.runs][:1]:
            raise ConcurrentRun(f"{self.database}: {self._remembered()[0][0]} was published in the meantime")
        changed = [t for t, (data, _) in self._staged.items() if t in self.current and self.current[t][0] != data]
        if not self.runs:
            self._point([("", {})])
        for table in self._staged:
            if table not in self.current:
                self._view(table)
        self._advance()
        for table in changed:
            self._view(table)
        self._staged.clear()
        self.collect_garbage(retention_hours)

    def _advance(self) -> None:
        """Replace the pointer. A run that publishes again, after a later stage, goes on as the same entry."""
        tables = {**self.current, **self._staged}
        earlier = self.runs[1:] if self.runs and self.runs[0][0] == self.run else self.runs
        self._point([(self.run, tables), *[r for r in earlier if r[0]]][:REMEMBERED])

    def _view(self, table: str) -> None:
        name, data = f"{self.database}.{table}", self._staged[table][0]
        if self.spark.catalog.tableExists(name) and self.spark.catalog.getTable(name).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {name}")     # a plain table, left by an earlier release
        columns = ", ".join(f"`{c}`" for c in self.spark.table(f"{self.database}.{data}").columns if c != BATCH)
        comment = self._notes.get(table)
        note = f" COMMENT {_quoted(comment)}" if comment else ""
        self.spark.sql(f"CREATE OR REPLACE VIEW {name}{note} AS SELECT {columns} FROM {self.database}.{data} "
                       f"WHERE array_contains((SELECT try_element_at(atual, {_quoted(table)}) FROM {self.database}.{POINTER}), {BATCH})")

    def roll_back(self) -> str:
        """Show the run before again; returns its name. Tables that only the withdrawn run had keep their view, without rows."""
        if len(self.runs) < 2:
            raise LookupError(f"{self.database}: no earlier run to go back to")
        withdrawn, back = self.runs[0][1], self.runs[1:]
        moved = [t for t, (data, _) in back[0][1].items() if withdrawn.get(t, (data, []))[0] != data]
        self._point(back)
        self._staged = {t: back[0][1][t] for t in moved}
        for table in moved:
            self._view(table)
        self._staged.clear()
        return back[0][0]

    def collect_garbage(self, retention_hours: float = RETENTION_HOURS) -> list[str]:
        """Drop batches that no remembered run lists and that are older than the retention: a reader that has begun on them, or a
        run that has not yet published them, still finds them for that long. Returns the batches dropped."""
        kept = {name for _, tables in self.runs for _, names in tables.values() for name in names}
        oldest = time.time() * 1000 - retention_hours * 3_600_000
        dropped = []
        for t in self.spark.catalog.listTables(self.database):
            if t.isTemporary or not re.fullmatch(r".+__dados_[0-9a-f]{8}", t.name):
                continue
            found = {dict(p.split("=", 1) for p in r[0].split("/"))[BATCH] for r in self.spark.sql(f"SHOW PARTITIONS {self.database}.{t.name}").collect()}
            for name in sorted(found - kept):
                written = re.match(r"v(\d+)x", name)
                if not name.startswith(self.run) and (written is None or int(written[1]) <= oldest):
                    self.spark.sql(f"ALTER TABLE {self.database}.{t.name} DROP IF EXISTS PARTITION ({BATCH} = {_quoted(name)})")
                    dropped.append(name)
        return dropped
