"""The star schema as catalog tables over Parquet, loaded by whole files.

Staging, facts and rejects are partitioned by ``source_file`` and written by dynamic partition overwrite: a
load replaces the partitions of its files and of the files that lose order ids to it, and no others. Facts
and staging are bucketed by ``order_id``, so they meet each other, and the order ids of a load, where they lie.

All checks run before the first write, so a load that breaks a rule changes nothing. The run log is written
last. A load that dies while it writes is repaired by running it again under the same id: every write
replaces what the first attempt left, keys included.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyworks.operators import merge as M
from tallyworks.operators.audit import constraint_audit
from tallyworks.operators.judge import IS_CLEAN, accepted, clean, measured
from tallyworks.plans.summaries import sums_of
from tallyworks.schemas import SUMS, TABLES, ddl
from tallyworks.workspace import Workspace, own_shuffles

BY_FILE = ("stg_sales", "fact_sales", "etl_rejected_sales", *SUMS)
BUCKETED = ("stg_sales", "fact_sales")
DIMENSIONS = {
    "dim_customers": ("customer_id", "customer_key"),
    "dim_products": ("product_id", "product_key"),
}
LOG, REPORT = "etl_run_log", "load_report"

#: Least buckets of a new warehouse. A load writes at least one output file for each of its files and buckets.
BUCKETS = 8
#: One task joins a bucket of both tables, all files together, so buckets follow the rows of the first load.
ROWS_PER_BUCKET = 2_000_000
#: Partitions of a dimension; only those with an incoming id are rewritten.
SLICES = 4
ROWS_PER_FILE = 4_000_000

#: Columns that a stored table has besides those of ``TABLES``; its partition column comes last.
STORED_MORE = {
    "dim_customers": {"slice": "int"},
    "dim_products": {"slice": "int"},
    # the last keys a load gave out, from which the next one goes on
    LOG: {"last_sales_key": "bigint", "last_rejected_id": "bigint", "load_id": "string"},
}
# What each load did to each table.
REPORT_COLUMNS = {
    "table_name": "string", "removed": "bigint", "inserted": "bigint", "updated": "bigint", "load_id": "string",
}


class ConstraintViolation(Exception):
    """A load whose new rows break a table constraint; nothing of it is written."""


def new_load_id() -> str:
    """Sorts by the clock; unique whatever the clock says."""
    return f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def run_id_of(load_id: str) -> Column:
    """One run per file of a load: a UUID made from both names."""
    digest = F.md5(F.concat_ws("/", F.lit(load_id), "source_file"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, at, n) for at, n in cuts])


def buckets_for(rows: int, least: int = BUCKETS) -> int:
    """Buckets of a warehouse whose first load brings this many rows."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


@contextmanager
def replacing_partitions(spark: SparkSession) -> Iterator[None]:
    """Overwrites that run meanwhile replace only the partitions they write."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Warehouse:
    """Tables under one root folder, opened in the session's catalog under a database of their own.

    ``buckets`` and ``sums``, whether loads keep up the sums of each file's facts, are settled when a warehouse is made.
    Where no bucket count is given, the first load's rows settle it.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, sums: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = f"tallyworks_{hashlib.md5(self.root.encode()).hexdigest()[:12]}"
        self.buckets, self.sums = buckets, sums
        self.known = False

    # --- tables

    @staticmethod
    def _stored(name: str) -> dict[str, str]:
        columns = REPORT_COLUMNS if name == REPORT else (TABLES | SUMS)[name] | STORED_MORE.get(name, {})
        last = Warehouse._partition(name)
        return {c: t for c, t in columns.items() if c != last} | {last: columns[last]}

    @staticmethod
    def _partition(name: str) -> str:
        return "source_file" if name in BY_FILE else "slice" if name in DIMENSIONS else "load_id"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def ensure_tables(self, rows: int = 0) -> None:
        """Create what is absent, for a first load of so many rows, and open what another session stored, with the
        bucket count it was made with."""
        layout, columns = f"{self.root}/layout", "buckets int, sums boolean"
        if not self.known:
            buckets = buckets_for(rows) if self.buckets is None else self.buckets
            self.spark.createDataFrame([(buckets, self.sums)], columns).write.mode("ignore").parquet(layout)
            stored = self.spark.read.schema(columns).parquet(layout).first()
            self.buckets, self.sums, self.known = stored["buckets"], bool(stored["sums"]), True
        if self.spark.catalog.databaseExists(self.database):
            return
        place = self.root.replace("'", "\\'")
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{place}'")
        for name in (*BY_FILE, *DIMENSIONS, LOG, REPORT):
            if name in SUMS and not self.sums:
                continue
            buckets = f"CLUSTERED BY (order_id) INTO {self.buckets} BUCKETS" if name in BUCKETED else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.table(name)} ({ddl(self._stored(name))}) USING parquet "
                "OPTIONS ('compression' = 'zstd') "
                f"PARTITIONED BY ({self._partition(name)}) {buckets} LOCATION '{place}/{name}'")
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            folder.getFileSystem(conf).mkdirs(folder)
            self.spark.sql(f"ALTER TABLE {self.table(name)} RECOVER PARTITIONS")

    def read(self, name: str) -> DataFrame:
        """The rows of a table."""
        return self._rows(name).select(*(TABLES | SUMS)[name])

    def _rows(self, name: str) -> DataFrame:
        self.ensure_tables()
        rows = self.spark.table(self.table(name))
        # a file without rows keeps an empty line that holds its partition; its key is null
        return rows.where(F.col(next(iter((TABLES | SUMS)[name]))).isNotNull()) if name in BY_FILE else rows

    def load_report(self, load_id: str | None = None) -> DataFrame:
        """Rows removed, inserted and updated by table, of one load or all."""
        self.ensure_tables()
        rows = self.spark.table(self.table(REPORT))
        return rows if load_id is None else rows.where(F.col("load_id") == F.lit(load_id))

    def _replace(self, name: str, rows: DataFrame, files: DataFrame | None = None) -> None:
        """Overwrite the partitions of ``rows``, and of ``files`` also where they have no row."""
        columns = self._stored(name)
        rows = rows.select(*columns)
        if name in BY_FILE:
            empty = [F.lit(None).cast(t).alias(c) for c, t in columns.items() if c != "source_file"]
            rows = rows.unionByName(files.select(*empty, "source_file"))
            # one output for each bucket of a file; rejects by share of a file. A huge file is many outputs
            key = "order_id" if name in BUCKETED else next(iter(columns))
            share = F.pmod(F.hash(key), F.lit(self.buckets)) if name in BUCKETED or name in SUMS \
                else F.floor(F.col("row_num") / ROWS_PER_FILE)
            rows = rows.repartition("source_file", share)
        elif name in DIMENSIONS:
            rows = rows.repartition("slice")
        else:
            rows = rows.coalesce(1)  # a few small rows for each file of a load
        with replacing_partitions(self.spark), own_shuffles(self.spark):
            rows.write.option("maxRecordsPerFile", ROWS_PER_FILE).insertInto(self.table(name), overwrite=True)

    # --- loading

    def load(
        self,
        judged: DataFrame,
        rejects: DataFrame,
        files: DataFrame,
        customers: DataFrame,
        products: DataFrame,
        space: Workspace,
        load_id: str | None = None,
        started_at: dt.datetime | None = None,
        passing: Mapping[str, Workspace] | None = None,
    ) -> DataFrame:
        """Load judged rows and their rejects, both written tables. Returns the run log rows of the load.

        ``files`` has one row per file of the load: ``source_file`` and ``last_row``, its last line number. ``passing``
        names workspaces that nobody reads once the table of that name is written; each is dropped then. The judged
        rows are last read for ``stg_sales``, the rejects for their own table.
        """
        passing = passing or {}
        load_id = load_id or new_load_id()
        started_at = started_at or dt.datetime.now()
        stamp = F.lit(dt.datetime.now())
        files = self._counted(files, judged, load_id, space)
        run_ids = files.select("source_file", "run_id")
        self.ensure_tables(files.agg(F.coalesce(F.sum("rows_valid"), F.lit(0)).alias("n")).first()["n"])
        last = self._last_keys(load_id)

        dims, changes = {}, []
        for name, incoming in (("dim_customers", customers), ("dim_products", products)):
            dims[name], change = self._merged(name, incoming, space, stamp)
            changes.append(change)

        staged = accepted(judged).join(run_ids, "source_file").withColumn("loaded_at", stamp)
        # what a row's own values or its file give is added once the rows no longer move
        winners = M.last_file_wins(clean(judged), files, space)
        facts = measured(M.resolve_keys(winners, dims["dim_customers"], dims["dim_products"]))
        facts = self._keyed(facts, "sales_key", last["last_sales_key"], files)
        facts = facts.join(run_ids, "source_file").withColumn("loaded_at", stamp)
        facts = space.settle(facts.select(*TABLES["fact_sales"]), "facts", dictionary=False)
        rejects = self._keyed(rejects, "rejected_id", last["last_rejected_id"], files)
        rejects = rejects.join(run_ids, "source_file").withColumn("rejected_at", stamp)

        kept, displaced = self._displaced(facts, files, space)
        report = space.settle(self._report(load_id, facts, files, displaced, changes), "report")
        runs = space.settle(self._runs(load_id, files, facts, started_at, last), "runs")
        new = {"stg_sales": staged, "fact_sales": facts, "etl_rejected_sales": rejects} | dims
        self._audit(new, self.read(LOG).join(runs, "run_id", "left_anti").unionByName(runs.select(*TABLES[LOG])))

        for name, rows in dims.items():
            self._replace(name, rows)
        for name, rows in (("stg_sales", staged), ("etl_rejected_sales", rejects)):
            self._replace(name, rows, files)
            if name in passing:
                passing[name].drop()
        touched = files.select("source_file").unionByName(displaced.select("source_file"))
        changed = facts.unionByName(kept)
        if self.sums:
            # before the facts: a load that runs again finds displaced files only while their facts are the old ones
            for name, rows in sums_of(changed).items():
                self._replace(name, rows, touched)
        self._replace("fact_sales", changed, touched)
        self._replace(REPORT, report)
        self._replace(LOG, runs)
        return self.read(LOG).join(runs.select("run_id"), "run_id", "left_semi")

    def _counted(self, files: DataFrame, judged: DataFrame, load_id: str, space: Workspace) -> DataFrame:
        """One row for each file of the load, also one without rows: its run, the rows it brings, its place among the
        files by name and the lines before it."""
        counted = judged.groupBy("source_file").agg(
            F.count(F.lit(1)).alias("rows_extracted"), F.count_if(F.expr(IS_CLEAN)).alias("rows_valid"))
        named = files.select("source_file", "last_row", run_id_of(load_id).alias("run_id"))
        whole = named.join(counted, "source_file", "left").na.fill(0, ["rows_extracted", "rows_valid"])
        # the window orders one row per file
        by_name = W.orderBy("source_file")
        before = F.sum("last_row").over(by_name.rowsBetween(W.unboundedPreceding, -1))
        places = {"file_no": F.row_number().over(by_name), "lines_before": F.coalesce(before, F.lit(0))}
        return space.settle(whole.withColumns(places), "files")

    def _last_keys(self, load_id: str) -> dict[str, int]:
        """The last keys given out by other loads; a load that runs again gives out its own keys again."""
        others = self._rows(LOG).where(F.col("load_id") != F.lit(load_id))
        names = ("last_sales_key", "last_rejected_id")
        return others.agg(*[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in names]).first().asDict()

    def _merged(self, name: str, incoming: DataFrame, space: Workspace, stamp: Column) -> tuple[DataFrame, DataFrame]:
        """The dimension after the load, and one row that counts what changes."""
        id_column, key = DIMENSIONS[name]
        before = self.read(name)
        known = M.last_key(before, key)
        merged = M.upsert_dim(before, incoming, id_column, key, space, stamp)
        merged = merged.withColumn("slice", F.pmod(F.hash(id_column), F.lit(SLICES)))
        merged = space.settle(merged, name)
        change = merged.agg(
            F.lit(name).alias("table_name"),
            F.lit(0).cast("bigint").alias("removed"),
            F.count_if(F.col(key) > known).alias("inserted"),
            F.count_if((F.col(key) <= known) & (F.col("updated_at") == stamp)).alias("updated"),
        )
        return merged, change

    @staticmethod
    def _keyed(rows: DataFrame, key: str, start: int, files: DataFrame) -> DataFrame:
        """Keys above all earlier ones: lines before this file in the load, plus the line number.

        Unique without counting, sorting or shuffling rows; as with any sequence, values may be
        left out.
        """
        placed = rows.join(files.select("source_file", "lines_before"), "source_file")
        return placed.withColumn(key, F.lit(start) + F.col("lines_before") + F.col("row_num"))

    def _displaced(self, facts: DataFrame, files: DataFrame, space: Workspace) -> tuple[DataFrame, DataFrame]:
        """What is left of other files that lose order ids to this load, and how many rows each loses.

        Lost are the ids staged earlier for the files of the load and the load's own. The ids meet the stored facts
        in their buckets; the least and greatest of them let whole row groups be skipped. Staging rows stay.
        """
        # the comparison lets the planner prune partitions by the files of the load
        ours = files.where("last_row > 0")
        others = self.read("fact_sales").join(files, "source_file", "left_anti")
        if self._holds_no_other(files):
            # no fact lies in another file, so none is displaced, and the ids need not be brought together
            none = others.where("false")
            return none.select(*TABLES["fact_sales"]), none.select("source_file", F.lit(0).cast("bigint").alias("lost"))
        doomed = space.settle(M.doomed_orders(self.read("stg_sales"), facts, ours), "doomed")
        ends = doomed.agg(F.min("order_id").alias("low"), F.max("order_id").alias("high")).first()
        near = others.where(F.col("order_id").between(F.lit(ends.low), F.lit(ends.high)))
        hit = near.join(doomed, "order_id", "left_semi").groupBy("source_file").agg(F.count(F.lit(1)).alias("lost"))
        hit = space.settle(hit, "displaced")
        kept = others.join(hit.where("lost > 0"), "source_file", "left_semi").join(doomed, "order_id", "left_anti")
        return space.settle(kept.select(*TABLES["fact_sales"]), "kept"), hit

    def _holds_no_other(self, files: DataFrame) -> bool:
        """Whether the stored facts have no partition besides those of these files."""
        stored = self.spark.sql(f"SHOW PARTITIONS {self.table('fact_sales')}")
        return stored.join(files.select(F.concat(F.lit("source_file="), "source_file").alias("partition")),
                           "partition", "left_anti").isEmpty()

    def _report(self, load_id: str, facts: DataFrame, files: DataFrame, displaced: DataFrame,
                changes: list[DataFrame]) -> DataFrame:
        """Counts of what goes and comes: the partitions of the load's files are replaced, other files lose rows."""
        rows = changes[0]
        for more in changes[1:]:
            rows = rows.unionByName(more)
        brought = {
            "stg_sales": files.agg(F.sum("rows_valid").alias("inserted")),
            "fact_sales": facts.agg(F.count(F.lit(1)).alias("inserted")),
            "etl_rejected_sales": files.agg(F.sum(F.col("rows_extracted") - F.col("rows_valid")).alias("inserted")),
        }
        lost = displaced.agg(F.coalesce(F.sum("lost"), F.lit(0)).alias("lost"))
        ours = files.where("last_row > 0").select("source_file")
        for name, counted in brought.items():
            gone = self.read(name).join(ours, "source_file", "left_semi").agg(F.count(F.lit(1)).alias("own"))
            both = gone.join(counted).join(lost)  # one row each
            rows = rows.unionByName(both.select(
                F.lit(name).alias("table_name"),
                (F.col("own") + (F.col("lost") if name == "fact_sales" else F.lit(0))).alias("removed"),
                F.coalesce("inserted", F.lit(0)).cast("bigint").alias("inserted"),
                F.lit(0).cast("bigint").alias("updated"),
            ))
        return rows.withColumn("load_id", F.lit(load_id)).select(*REPORT_COLUMNS)

    def _runs(self, load_id: str, files: DataFrame, facts: DataFrame, started_at: dt.datetime,
              last: dict[str, int]) -> DataFrame:
        """One run per file, with the last keys of the load on each."""
        loaded = facts.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_loaded"))
        lines = files.agg(F.coalesce(F.sum("last_row"), F.lit(0)).alias("n")).first()["n"]
        runs = files.join(loaded, "source_file", "left").na.fill(0, ["rows_loaded"])
        return runs.select(
            "run_id",
            "source_file",
            F.lit(started_at).alias("started_at"),
            F.lit(dt.datetime.now()).alias("finished_at"),
            "rows_extracted",
            "rows_valid",
            (F.col("rows_extracted") - F.col("rows_valid")).alias("rows_rejected"),
            "rows_loaded",
            F.lit("SUCCESS").alias("status"),
            *[F.lit(at + lines).cast("bigint").alias(name) for name, at in last.items()],
            F.lit(load_id).alias("load_id"),
        )

    @staticmethod
    def _audit(new: dict[str, DataFrame], log: DataFrame) -> None:
        with own_shuffles(log.sparkSession):
            broken = constraint_audit(new | {LOG: log}).where("violations > 0").collect()
        if broken:
            raise ConstraintViolation(
                "; ".join(f"{r.table_name} {r.constraint_name}: {r.violations}" for r in broken)
            )
