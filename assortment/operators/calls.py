"""Calls of functions that are handed in and cost money: bounded retries, progress and replies that last."""

import posixpath
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ATTEMPTS = 3


def retried(call: Callable, attempts: int = ATTEMPTS) -> Callable:
    """`call`, tried up to `attempts` times."""

    def again(*args):
        for left in reversed(range(attempts)):
            try:
                return call(*args)
            except Exception:
                if not left:
                    raise

    return again


def in_groups(rows: DataFrame, column: str, size: int) -> Iterator[DataFrame]:
    """The rows in runs of `size` whole numbers of `column`, in order. `rows` is a written table.

    Each run is for one job that commits, so a failure costs one run and not those before it.
    """
    last = rows.agg(F.max(column)).first()[0]
    for start in range(0, 0 if last is None else last + 1, size):
        yield rows.where(F.col(column).between(start, start + size - 1))


REPLIES = "reply_key string, text string, tokens_input long, tokens_output long"


def reply_key(model: str, prompt: Column) -> Column:
    """What a reply is stored under: a digest of model and prompt."""
    return F.sha2(F.concat(F.lit(f"{model}\n"), F.coalesce(prompt, F.lit("\n"))), 256)


class Ledger:
    """Replies that were paid for, in a folder that driver and executors share.

    A task stores the replies of each call in a file of its own before it makes the next call, under a hidden name first,
    so that a half-written file is never read. Whoever comes next, be it another attempt of the task or another run, finds
    them by model and prompt. The folder is a path or URI that pyarrow can open on the executors.
    """

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def known(self, spark: SparkSession) -> DataFrame:
        """A reply per key."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return spark.createDataFrame([], REPLIES)
        stored = spark.read.schema(REPLIES).option("recursiveFileLookup", "true").parquet(self.folder)
        names = [c for c in stored.columns if c != "reply_key"]
        one = stored.groupBy("reply_key").agg(F.min(F.struct(*names)).alias("reply"))
        return one.select("reply_key", "reply.*")

    def book(self) -> Callable[[], "_Page"]:
        """Opens the page of a task in one job; tasks of the job that are run again get the same page."""
        folder = f"{self.folder}/job-{uuid.uuid4().hex}"
        return lambda: _Page(folder, TaskContext.get().partitionId())


class _Page:
    """The replies that one task of a job has stored."""

    def __init__(self, folder: str, task: int):
        scheme, _, path = folder.rpartition(":/")
        local = scheme in ("", "file")
        here = f"/{path.lstrip('/')}" if scheme else folder
        self.store, self.folder = (pafs.LocalFileSystem(), here) if local else pafs.FileSystem.from_uri(folder)
        self.folder, self.replies = posixpath.join(self.folder, f"task-{task}"), {}
        self.store.create_dir(self.folder, recursive=True)
        for found in self.store.get_file_info(pafs.FileSelector(self.folder)):
            if found.base_name.startswith("reply-"):
                with self.store.open_input_file(found.path) as source:
                    for row in pq.read_table(source).to_pylist():
                        self.replies[row["reply_key"]] = (row["text"], row["tokens_input"], row["tokens_output"])

    def add(self, keys: list[str], replies: list[tuple[str, int, int]]) -> None:
        columns = [list(keys), *([r[n] for r in replies] for n in range(3))]
        types = [pa.string(), pa.string(), pa.int64(), pa.int64()]
        names = ["reply_key", "text", "tokens_input", "tokens_output"]
        table = pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})
        name = uuid.uuid4().hex
        with self.store.open_output_stream(f"{self.folder}/_{name}") as out:
            pq.write_table(table, out)
        self.store.move(f"{self.folder}/_{name}", f"{self.folder}/reply-{name}.parquet")
        self.replies.update(zip(keys, replies))
