"""Shared helpers of the training-data operators: reading tables, cutting lineage, size-checked broadcasts."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word definition `[^\x20\x09-\x0D]+`.
BLANKS = " \t\n\x0b\x0c\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Rows a table may have and still be broadcast by `broadcast_if_small`.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset a temporary one is made, in local mode only (tests)."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quernel-"))
        where = spark.sparkContext.getCheckpointDir()
    return where.rstrip("/")


def stash_folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables and archives lie."""
    return f"{shared_dir(spark)}/quernel-{spark.sparkContext.applicationId}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write df as Parquet into the shared folder and read it back (survives lost executors, keeps statistics)."""
    spark = df.sparkSession
    path = f"{stash_folder(spark)}/stash-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_stash(df: DataFrame) -> None:
    """Delete what `stash` wrote for df, once no later plan reads it."""
    for file in df.inputFiles()[:1]:
        folder = file.rsplit("/", 1)[0]
        if "/stash-" in folder and f"/quernel-{df.sparkSession.sparkContext.applicationId}/" in folder:
            _delete(df.sparkSession, folder)


def release_stashes(spark: SparkSession) -> None:
    """Delete all stashes of this application; call it when no result of an operator is read any more."""
    _delete(spark, stash_folder(spark))


def sweep(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now. It does so once the driver's garbage collector finds them unreferenced, which may take long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when df (stashed, so cheap to count) has at most `rows` rows; else Spark shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def split_join(rows: DataFrame, groups: DataFrame, on: list[str], n: str = "n", how: str = "left", share: int = 100_000) -> DataFrame:
    """rows joined to groups (stashed, one row a key, `n` rows of `rows` with it) on null-safe equality of `on`.

    Small tables are broadcast. Else the groups that hold more than 1 / share of all rows, so at most `share` of them, are broadcast
    and only the rest is shuffled: no key's rows meet in one task."""
    mine = {c: f"_of_group_{i}" for i, c in enumerate(on)}
    groups = groups.withColumnsRenamed(mine)
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(m)) for c, m in mine.items()])

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        return left.join(right, same, how).drop(*mine.values())

    if groups.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return joined(rows, F.broadcast(groups.drop(n)), how)
    many = F.col(n) > F.lit(max(1000, groups.agg(F.sum(n)).first()[0] // share))
    hot = groups.where(many).drop(n)
    rest = rows.join(F.broadcast(hot.select(*mine.values())), same, "left_anti")
    return joined(rows, F.broadcast(hot), "inner").unionByName(joined(rest, groups.where(~many).drop(n), how))


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores added until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: Column) -> Column:
    """Stands for a whole text where rows are told apart by content; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the Arrow batches that Python workers get: texts can be long, and two workers share an executor's memory."""
    held = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if held <= 0 or held > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it several times in `body` (a lambda variable is never inlined)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def words_of(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\x09-\\x0D]+"))


def sql_words(text: str) -> str:
    """DuckDB twin of `words_of`."""
    return f"regexp_extract_all(coalesce({text}, ''), '[^\\x20\\x09-\\x0D]+')"
