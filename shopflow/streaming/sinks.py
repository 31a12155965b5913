"""Idempotent file sinks for ``foreachBatch``.

A micro-batch writes its rows under ``batch_id=<n>`` with dynamic partition
overwrite, so a batch that is retried after a failure (same id, same input
offsets) replaces its own output instead of appending a duplicate. The id
includes the run (``run_batch``), so a new checkpoint never overwrites what an
earlier one stored. Keyed
(upsert) outputs keep every version and expose the latest one per key through
``latest_view``; ``compact_keyed`` writes that view beside the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.operators.dedup import latest_per_key

BATCH_COL = "batch_id"
KEY_BUCKET = "key_bucket"
#: folders that a batch of a keyed table is dealt into; a lookup reads those of
#: its keys
KEY_BUCKETS = 64
#: batch ids a checkpoint can use: 15 years of one batch every 5 seconds
RUN_BATCHES = 100_000_000


def run_batch(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """Batch id that no other checkpoint uses: the tenth of a second at which
    the checkpoint was created (its ``metadata`` file is written once and
    stays across restarts) in front of the query's own batch id.

    A restart or retry under the same checkpoint gets the same id and replaces
    its own output; a query under a new checkpoint starts at batch 0 again but
    gets larger ids than every earlier run, so it replaces nothing and sorts
    after what is stored."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    created = fs.getFileStatus(path).getModificationTime() // 100
    return created * RUN_BATCHES + batch_id


def write_batch(df: DataFrame, batch_id: int, path: str,
                partition_cols: Sequence[str] = (), fmt: str = "parquet", **options) -> None:
    """SNK1: write one micro-batch; re-running the same batch id replaces
    exactly the partitions that batch owns. ``options`` are the format's."""
    (df.withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols, BATCH_COL)
     .format(fmt).options(**options).save(path))


def table_sink(path: str, partition_cols: Sequence[str] = (),
               transform: Callable[[DataFrame, int], DataFrame] | None = None,
               fmt: str = "parquet", upper: bool = False) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: optional per-batch transform, then write.
    ``upper=True`` stores the declared field names upper-cased (the SQL
    table convention of SNK1)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch, batch_id) if transform else batch
        parts = list(partition_cols)
        if upper:
            out = out.toDF(*[c.upper() for c in out.columns])
            parts = [c.upper() for c in parts]
        write_batch(out, batch_id, path, parts, fmt)
    return run


def read_table(spark: SparkSession, path: str, before_batch: int | None = None,
               empty_schema: str | None = None) -> DataFrame:
    """All rows written so far (optionally only by batches before one id, so
    a retried batch never sees its own earlier attempt).

    A table whose batches were all empty (or that does not exist yet) has no
    data files; with ``empty_schema`` it reads as an empty DataFrame of that
    schema instead of failing the micro-batch."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if empty_schema is None or not (
                "UNABLE_TO_INFER_SCHEMA" in str(e) or "PATH_NOT_FOUND" in str(e)):
            raise
        df = spark.createDataFrame([], f"{empty_schema}, {BATCH_COL} long")
    df = df.withColumn(BATCH_COL, F.col(BATCH_COL).cast("long"))
    if before_batch is not None:
        df = df.filter(F.col(BATCH_COL) < before_batch)
    return df


def read_days(spark: SparkSession, path: str, day_col: str, days: Sequence[str],
              before_batch: int | None = None, empty_schema: str | None = None,
              after_batch: int | None = None) -> DataFrame:
    """Rows of the given day partitions only. Only those day directories are
    listed (``basePath`` keeps ``day_col`` as a column), so the cost of a
    read does not grow with the number of days and batches in the table. A day
    that ``compact_days`` has rewritten is read from its newest compaction plus
    the batches after it. ``after_batch`` leaves out batches up to that one."""
    path = path.rstrip("/")
    plain, packed = [], []
    for d in days:
        own = f"{path}/{day_col}={d}"
        done = _child_values(spark, f"{compacted_path(path)}/{day_col}={d}", "upto")
        base = done[-1] if done and (after_batch is None or after_batch < done[-1]) else None
        if base is not None:
            packed.append(f"{compacted_path(path)}/{day_col}={d}/upto={base}")
        low = max([x for x in (base, after_batch) if x is not None], default=None)
        if low is None:
            plain += [own] if path_exists(spark, own) else []
        else:
            plain += [f"{own}/{BATCH_COL}={i}" for i in _child_values(spark, own, BATCH_COL) if i > low]
    read = []
    for root, folders in ((compacted_path(path), packed), (path, plain)):
        if not folders:
            continue
        try:
            df = spark.read.option("basePath", root).parquet(*folders).drop("upto")
        except AnalysisException as e:
            if empty_schema is None or "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            continue
        read.append(df.withColumn(BATCH_COL, F.col(BATCH_COL).cast("long")))
    if not read:
        if empty_schema is None:
            raise ValueError(f"no partitions of {path} for {list(days)}")
        read = [spark.createDataFrame([], f"{empty_schema}, {BATCH_COL} long")]
    df = read[0] if len(read) == 1 else read[0].unionByName(read[1], allowMissingColumns=True)
    if before_batch is not None:
        df = df.filter(F.col(BATCH_COL) < before_batch)
    if after_batch is not None:
        df = df.filter(F.col(BATCH_COL) > after_batch)
    return df


def compact_days(spark: SparkSession, path: str, day_col: str, days: Sequence[str],
                 files: int = 1) -> dict[str, int]:
    """SNK1: rewrites days' many batch folders as one folder each, beside the
    table (``<path>__compacted/<day>/upto=<batch>``; rows keep their batch id).
    Nothing that readers may be reading is touched. Returns the batch covered
    per day."""
    out = {}
    for d in days:
        ids = _child_values(spark, f"{path.rstrip('/')}/{day_col}={d}", BATCH_COL)
        if not ids:
            continue
        rows = read_days(spark, path, day_col, [d], before_batch=ids[-1] + 1).drop(day_col)
        rows.repartition(files).write.mode("overwrite").parquet(
            f"{compacted_path(path)}/{day_col}={d}/upto={ids[-1]}")
        out[d] = ids[-1]
    return out


def drop_compacted(spark: SparkSession, path: str, day_col: str, days: Sequence[str]) -> int:
    """Removes the batch folders that days' newest compactions cover, and older
    compactions; run it when no reader that started before the compaction is
    left. Returns how many folders went."""
    jvm, gone = spark.sparkContext._jvm, 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for d in days:
        packed, own = f"{compacted_path(path)}/{day_col}={d}", f"{path.rstrip('/')}/{day_col}={d}"
        done = _child_values(spark, packed, "upto")
        old = [f"{packed}/upto={u}" for u in done[:-1]]
        if done:
            old += [f"{own}/{BATCH_COL}={i}" for i in _child_values(spark, own, BATCH_COL) if i <= done[-1]]
        for folder in old:
            p = jvm.org.apache.hadoop.fs.Path(folder)
            gone += bool(p.getFileSystem(conf).delete(p, True))
    return gone


def key_bucket(keys: Sequence[str], buckets: int = KEY_BUCKETS) -> Column:
    """Bucket of a key, the same for numbers and their text."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("string")


def write_keyed(df: DataFrame, batch_id: int, path: str, keys: Sequence[str], buckets: int = KEY_BUCKETS) -> None:
    """One micro-batch of a keyed table, laid out by key bucket below the
    batch's folder. A table has one number of buckets."""
    (df.withColumn(KEY_BUCKET, key_bucket(keys, buckets)).withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
     .repartition(KEY_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BATCH_COL, KEY_BUCKET).parquet(path))


def keyed_sink(path: str, keys: Sequence[str], buckets: int = KEY_BUCKETS) -> Callable[[DataFrame, int], None]:
    return lambda batch, batch_id: write_keyed(batch, batch_id, path, keys, buckets)


def latest_view(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """SNK2/WIN2: latest version per key: highest batch id (numeric), then
    ``order``."""
    df = df.withColumn(BATCH_COL, F.col(BATCH_COL).cast("long"))
    return latest_per_key(df, list(keys), [BATCH_COL, *order])


def _child_values(spark: SparkSession, path: str, name: str) -> list[int]:
    """Values of the ``name=<int>`` child folders of ``path`` (one directory
    listing, no recursion)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        n = st.getPath().getName()
        if st.isDirectory() and n.startswith(name + "="):
            try:
                out.append(int(n.split("=", 1)[1]))
            except ValueError:
                pass
    return sorted(out)


def compacted_path(path: str) -> str:
    return path.rstrip("/") + "__compacted"


def compact_keyed(spark: SparkSession, path: str, keys: Sequence[str],
                  order: Sequence[str] = ()) -> int | None:
    """Write the latest version per key of everything up to the newest batch
    into a new folder ``<path>__compacted/upto=<batch>`` (never over a folder
    that readers may be reading). Returns the batch id covered."""
    ids = _child_values(spark, path, BATCH_COL)
    if not ids:
        return None
    upto = ids[-1]
    latest = read_keyed(spark, path, keys, order, upto=upto)
    target = f"{compacted_path(path)}/upto={upto}"
    if KEY_BUCKET in latest.columns:
        latest.repartition(KEY_BUCKET).write.mode("overwrite").partitionBy(KEY_BUCKET).parquet(target)
    else:
        latest.write.mode("overwrite").parquet(target)
    return upto


def read_keyed(spark: SparkSession, path: str, keys: Sequence[str],
               order: Sequence[str] = (), empty_schema: str | None = None,
               upto: int | None = None, only: DataFrame | None = None,
               buckets: int = KEY_BUCKETS) -> DataFrame:
    """Latest version per key of a keyed (upsert) table: the newest
    compaction plus only the batch folders written after it, so the read
    does not list or scan the table's whole history. With ``only`` (a table of
    keys) other keys are left out before their versions are compared, and of a
    table that ``write_keyed`` laid out only the folders of their buckets are
    listed and read (the numbers that occur, at most ``buckets``, are collected)."""
    done = [d for d in _child_values(spark, compacted_path(path), "upto") if upto is None or d <= upto]
    base = done[-1] if done else None
    ids = [i for i in _child_values(spark, path, BATCH_COL)
           if (base is None or i > base) and (upto is None or i <= upto)]
    touched = None
    if only is not None:
        touched = {int(r[0]) for r in only.select(key_bucket(keys, buckets).alias("b")).distinct().collect()}
    parts = []
    if base is not None:
        own = f"{compacted_path(path)}/upto={base}"
        parts.append((own, _bucket_folders(spark, own, touched)))
    newer = [f for i in ids for f in _bucket_folders(spark, f"{path.rstrip('/')}/{BATCH_COL}={i}", touched)]
    parts.append((path, newer))
    read = [spark.read.option("basePath", root).parquet(*folders).withColumn(BATCH_COL, F.col(BATCH_COL).cast("long"))
            for root, folders in parts if folders]
    if not read:
        if empty_schema is None:
            if only is None or not (base is not None or ids):
                raise ValueError(f"{path} has no data")
            return read_keyed(spark, path, keys, order, upto=upto).join(only, list(keys), "left_semi")
        return spark.createDataFrame([], f"{empty_schema}, {BATCH_COL} long, {KEY_BUCKET} string")
    df = read[0]
    for extra in read[1:]:
        df = df.unionByName(extra, allowMissingColumns=True)
    if only is not None:
        df = df.join(only, list(keys), "left_semi")
    return latest_view(df, keys, order)


def _bucket_folders(spark: SparkSession, folder: str, touched: set[int] | None) -> list[str]:
    """The folder itself, or of one that is laid out by key bucket the touched
    buckets (one listing, no recursion)."""
    if touched is None:
        return [folder]
    there = _child_values(spark, folder, KEY_BUCKET)
    return [f"{folder}/{KEY_BUCKET}={b}" for b in there if b in touched] if there else [folder]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)
