"""Parquet tables of a catalogue: read, replace, append, reload, run log."""

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assortment import fixed
from assortment.sources.schemas import TABLES, enforce_schema

RUN_EVENTS = "run_events"
COMMITS = "commits"


class Catalogue:
    """Tables in one folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(TABLES[table]).parquet(self.path(table))

    def overwrite(self, df: DataFrame, table: str) -> None:
        """Create or replace. `df` must not read the table itself; see `reload`."""
        enforce_schema(df, table).write.mode("overwrite").parquet(self.path(table))

    def append(self, df: DataFrame, table: str) -> None:
        """Add rows. A failed task fails the job, and the job commits all of its files or none."""
        enforce_schema(df, table).write.mode("append").parquet(self.path(table))

    def create(self, table: str) -> None:
        """Make the table with no rows unless it is there."""
        empty = self.spark.createDataFrame([], TABLES[table])
        empty.write.mode("ignore").parquet(self.path(table))

    def reload(self, df: DataFrame, table: str) -> None:
        """Replace all rows: write a new snapshot, then name it as the current one.

        Every call writes a snapshot of its own and the newest commit counts, so a run that failed may be started
        again with the same clock. Readers keep the former snapshot until the name is switched, so `df` may read
        the table. Snapshots that no name stands for are never read.
        """
        snapshot = uuid.uuid4().hex
        rows = enforce_schema(df, table).withColumn("snapshot", F.lit(snapshot))
        rows.write.mode("append").partitionBy("snapshot").parquet(self.path(table))
        self._commit(table, snapshot)

    def _commits(self, table: str):
        """File system and path of the folder of a table's commits, a small file per number."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(f"{COMMITS}/{table}"))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _numbers(self, table: str) -> list[int]:
        """The numbers of the commits there are, newest first."""
        store, folder = self._commits(table)
        if not store.exists(folder):
            return []
        names = [status.getPath().getName() for status in store.listStatus(folder)]
        return sorted((int(n) for n in names if n.isdecimal()), reverse=True)

    def _commit(self, table: str, name: str) -> int:
        """Make `name` the newest of a table: the first number whose file is not there yet and can be created.

        Of two runs that try the same number one creates the file, the other goes on to the next number.
        """
        store, folder = self._commits(table)
        store.mkdirs(folder)
        number = next(iter(self._numbers(table)), 0) + 1
        while not self._created(store, f"{folder.toString()}/{number:012d}", f"{name}\n".encode()):
            number += 1
        return number

    def _created(self, store, path: str, content: bytes) -> bool:
        """Create a file; False if it is there. Stores other than the local one create exclusively by themselves."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        try:
            if store.getUri().getScheme() == "file":
                with open(target.toUri().getPath(), "xb") as out:
                    out.write(content)
                return True
            out = store.create(target, False)
        except FileExistsError:
            return False
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        out.write(bytearray(content))
        out.close()
        return True

    def _newest(self, table: str) -> tuple[int, str] | None:
        """Number and name of the newest commit of a table. Nothing is written; a commit that a failure left without
        its name does not count."""
        store, folder = self._commits(table)
        for number in self._numbers(table):
            stream = store.open(self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder.toString()}/{number:012d}"))
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("\n"):
                return number, text[:-1]
        return None

    def read_reloaded(self, table: str) -> DataFrame:
        """Rows of the current snapshot; only its partition is scanned. No rows before the first reload."""
        newest = self._newest(table)
        if not newest:
            return self.spark.createDataFrame([], TABLES[table])
        schema = "snapshot string, " + ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in TABLES[table]
        )
        rows = self.spark.read.schema(schema).parquet(self.path(table))
        return rows.where(F.col("snapshot") == newest[1]).drop("snapshot")

    def new_index(self) -> str:
        """The path of an index that is about to be written."""
        return f"{self.path('indexes')}/{uuid.uuid4().hex}"

    def name_index(self, path: str) -> None:
        """From now on `path` is the index of this catalogue."""
        self._commit("index", path)

    def index(self) -> str | None:
        """The path of the newest index."""
        newest = self._newest("index")
        return newest and newest[1]

    def run_events(self) -> DataFrame:
        return self.spark.read.schema(run_event_schema()).parquet(self.path(RUN_EVENTS))

    def log(self, event: DataFrame) -> None:
        event.write.mode("append").parquet(self.path(RUN_EVENTS))


def run_event_schema() -> str:
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in TABLES["pipeline_runs"]]
    return ", ".join(["event_at timestamp"] + columns)


def run_event(
    rows: DataFrame, event_at, status: str, started_at, run_id, products=None, clusters=None, error=None
) -> DataFrame:
    """Status rows of runs: one per row of `rows`. Arguments but `status` are columns."""
    null = F.lit(None)
    done = null if status == "IN_PROGRESS" else event_at
    message = null if error is None else error_text(error)
    return rows.select(
        event_at.cast("timestamp").alias("event_at"),
        run_id.cast("string").alias("run_id"),
        started_at.cast("timestamp").alias("started_at"),
        done.cast("timestamp").alias("completed_at"),
        F.lit(status).alias("status"),
        (null if products is None else products).cast("long").alias("products_processed"),
        (null if clusters is None else clusters).cast("long").alias("clusters_created"),
        message.cast("string").alias("error_message"),
    )


def error_text(error) -> "F.Column":
    """Quotes escaped, then cut to the error length."""
    return F.substring(F.replace(error, F.lit("'"), F.lit("\\'")), 1, fixed.ERROR_MAX_CHARS)


def latest_runs(events: DataFrame) -> DataFrame:
    """One row per run: its newest event (a closing status outranks the start at the same time)."""
    closing = (F.col("status") != "IN_PROGRESS").cast("int")
    newest = Window.partitionBy("run_id").orderBy(
        F.desc("event_at"), closing.desc(), F.asc("status"), F.desc_nulls_last("products_processed"),
        F.desc_nulls_last("clusters_created"), F.asc_nulls_last("error_message"), F.asc("started_at"),
    )
    ranked = events.withColumn("_rank", F.row_number().over(newest))
    return ranked.where("_rank = 1").select(*[f.name for f in TABLES["pipeline_runs"]])


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("layer"), "record_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def latest_snapshot(report: DataFrame) -> DataFrame:
    """Newest quality row; of equal times the one with most products, then by the other columns."""
    others = [F.desc(c) for c in report.columns if c != "report_timestamp"]
    return report.orderBy(F.desc("report_timestamp"), *others).limit(1)
