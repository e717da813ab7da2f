"""Sinks and file layout: writes, compaction, partition sizing, large sorts.

File counts come from measured sizes, never constants: a fixed number of
files is too many at 1 GB and too few at 100 TB.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import ROW_OVERHEAD, row_bytes
from strata.session import conf_for, materialize

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
SMALL_FILE_BYTES = 32 * 1024 * 1024


def write_format(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 **options) -> DataFrame:
    """Write ``df`` in any built-in format and return it read back with its schema."""
    df.write.mode(mode).format(fmt).options(**options).save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).options(**options).load(path)


def write_uncontrolled(df: DataFrame, path: str) -> DataFrame:
    """Write with whatever partitioning the plan left (one file per task)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _plain_path(path):
    """A file's path in one form: listings and row metadata write ``file:`` differently."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row per file under ``path`` (partition folders included, empty files
    too): ``file_path`` and ``file_size``. Only the listing is read, no content."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", pattern).load(path))
    return listed.select(_plain_path(F.col("path")).alias("file_path"), F.col("length").alias("file_size"))


def input_bytes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row: number and total size of the ``*.<fmt>`` files under ``path``."""
    return list_files(spark, path, f"*.{fmt}").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("input_bytes"))


def size_partitions(spark: SparkSession, path: str, target_bytes: int = TARGET_PARTITION_BYTES,
                    min_partitions: int = 4, fmt: str = "parquet") -> DataFrame:
    """One row: files, bytes and the partition count ``max(min, ceil(bytes / target))``."""
    b = input_bytes(spark, path, fmt)
    n = F.greatest(F.lit(min_partitions), F.ceil(F.col("input_bytes") / F.lit(target_bytes)))
    return b.select("files", "input_bytes", F.lit(target_bytes).cast("bigint").alias("target_bytes"),
                    n.cast("int").alias("partitions"))


def partitions_for(spark: SparkSession, path: str, target_bytes: int = TARGET_PARTITION_BYTES,
                   min_partitions: int = 4, fmt: str = "parquet") -> int:
    """The partition count of :func:`size_partitions` as a number (one small row)."""
    return int(size_partitions(spark, path, target_bytes, min_partitions, fmt).first()["partitions"])


def repartition_by_size(df: DataFrame, partitions: int) -> DataFrame:
    """Round-robin ``df`` into ``partitions`` even partitions (content unchanged)."""
    return df.repartition(partitions)


def write_compacted(df: DataFrame, path: str, files: int | None = None, max_records_per_file: int = 0) -> DataFrame:
    """Write ``df`` as few, even files.

    * ``files``: round-robin into exactly that many (``repartition``, not
      ``coalesce``, so the upstream stage keeps its full parallelism).
    * otherwise the ``rebalance`` hint, so AQE sizes the final shuffle's
      partitions from measured shuffle bytes toward
      ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` - one pass, file count
      growing with the data.
    """
    shaped = df.repartition(files) if files else df.hint("rebalance")
    w = shaped.write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


OPEN_FILES = 8      # that a task writes side by side


def write_partitioned(df: DataFrame, path: str, *by: str, mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """Write ``df`` into a folder per value of ``by``, as it lies in its partitions.

    Spark sorts a task's rows by folder first, all of them, so that one file is open
    at a time. Here a task writes its rows as they come, into up to OPEN_FILES files side
    by side; it sorts only the rows that are left once it has met more values than that."""
    with conf_for(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)):
        df.write.mode(mode).format(fmt).partitionBy(*by).save(path)


def write_file_per_value(df: DataFrame, path: str, *by: str, mode: str = "errorifexists") -> None:
    """Write ``df`` into a folder per value of ``by``, one file each: a value's rows
    go to one task, which holds no more of them than the file's open row group."""
    folder = [F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")) for c in by]      # empty and null share a folder
    write_partitioned(df.repartition(*folder), path, *by, mode=mode)


def file_layout_report(spark: SparkSession, path: str, small_bytes: int = SMALL_FILE_BYTES,
                       fmt: str = "parquet") -> DataFrame:
    """Per ``*.<fmt>`` file: path, size, rows and whether it is a small file.
    Files of one name in several partition folders, and files without rows,
    are rows of their own."""
    rows = (spark.read.format(fmt).load(path).groupBy(_plain_path(F.col("_metadata.file_path")).alias("_path"))
            .agg(F.count(F.lit(1)).alias("rows")))
    files = list_files(spark, path, f"*.{fmt}")
    return (files.join(rows, F.col("file_path") == F.col("_path"), "left")
            .select("file_path", "file_size", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
                    (F.col("file_size") < F.lit(small_bytes)).alias("is_small")))


def scan_text(df: DataFrame, path: str, **options) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` as JSON lines and scan them as text: the lines with the file
    each came from (``value``, ``file_path``), and the folder's listing."""
    df.write.mode("overwrite").options(**options).json(path)
    spark = df.sparkSession
    lines = spark.read.text(path).select("value", _plain_path(F.col("_metadata.file_path")).alias("file_path"))
    return lines, list_files(spark, path, "*.json")


def file_layout_summary(report: DataFrame) -> DataFrame:
    """One row over a :func:`file_layout_report`: files, bytes, rows, small files."""
    return report.agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"),
                      F.sum("rows").alias("rows"),
                      F.sum(F.col("is_small").cast("int")).alias("small_files"),
                      F.min("file_size").alias("min_file_size"), F.max("file_size").alias("max_file_size"))


def partition_row_counts(df: DataFrame) -> DataFrame:
    """Rows per partition of ``df`` as it stands (no ``.rdd``)."""
    return (df.select(F.spark_partition_id().alias("partition_id"))
              .groupBy("partition_id").agg(F.count(F.lit(1)).alias("rows")))


def large_sort(df: DataFrame, *cols, num_partitions: int | None = None) -> DataFrame:
    """Total order: a range exchange on sampled bounds, then an external
    (spilling) sort inside each range - the physical plan of ``orderBy``,
    written out so the range partitioning survives later operators (a global
    sort feeding an aggregate is otherwise dropped by the optimizer).
    Partition ``i`` holds keys no larger than partition ``i + 1``."""
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)


def sort_order_report(sorted_df: DataFrame, cols: list[str]) -> DataFrame:
    """One row over a frame as it lies in its partitions: ``rows``, and
    ``in_order``: no row is smaller (by ``cols``, ascending, nulls first) than the
    one before it in its partition, and no partition begins below the end of one
    before it. Every task reads its rows once and passes on its first and last."""
    schema = sorted_df.select(*cols).schema

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ok, first, last = 0, True, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            here = pa.Table.from_batches([batch])
            first = first if first is not None else here.slice(0, 1)
            run = pa.concat_tables([last, here]) if last is not None else here
            order = pc.sort_indices(run, sort_keys=[(c, "ascending") for c in cols], null_placement="at_start")
            ok = ok and _same_order(run, order)
            rows, last = rows + batch.num_rows, here.slice(batch.num_rows - 1)
        if rows:
            out = {"rows": pa.array([rows]), "ok": pa.array([ok])}
            for name, at in (("first", first), ("last", last)):
                out[name] = pa.StructArray.from_arrays([at[c].combine_chunks() for c in cols], cols)
            yield pa.RecordBatch.from_pydict(out)

    def _same_order(run: pa.Table, order: pa.Array) -> bool:
        """Whether sorting leaves every row's values where they are (equal rows may swap)."""
        sorted_run = run.take(order)
        return all(sorted_run[c].combine_chunks().equals(run[c].combine_chunks()) for c in cols)

    struct = "struct<" + ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in schema) + ">"
    parts = (sorted_df.select(*cols)
             .mapInArrow(ends, f"rows long, ok boolean, first {struct}, last {struct}")
             .withColumn("p", F.spark_partition_id()))
    from pyspark.sql import Window

    before = F.max("last").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1))     # one row per partition
    return (parts.withColumn("before", before)
            .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                 F.coalesce(F.bool_and(F.col("ok") & F.coalesce(F.col("first") >= F.col("before"), F.lit(True))), F.lit(True)).alias("in_order")))


def sort_boundary_report(sorted_df: DataFrame, col: str) -> DataFrame:
    """Per partition of a sorted frame: rows, min and max of ``col``, and
    whether the partition starts at or after the previous one's maximum."""
    from pyspark.sql import Window

    per = (sorted_df.select(F.spark_partition_id().alias("partition_id"), F.col(col).alias("v"))
           .groupBy("partition_id").agg(F.count(F.lit(1)).alias("rows"),
                                        F.min("v").alias("min_value"), F.max("v").alias("max_value")))
    prev = F.lag("max_value").over(Window.orderBy("partition_id"))  # one row per partition
    return per.withColumn("ordered_after_previous", F.coalesce(F.col("min_value") >= prev, F.lit(True)))


# ---------------------------------------------------------------------------
# Compacting a folder in place
# ---------------------------------------------------------------------------

FILES_AT_ONCE = 10_000      # packed by one task


def first_fit_decreasing(sizes: list[int], room: int) -> list[int]:
    """The bin of each size: the largest first, each into the first bin with room.

    A tournament tree over the bins' free room finds that bin in logarithmic time."""
    n = 1 << max(len(sizes) - 1, 0).bit_length()
    free = [room] * (2 * n)
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = 1
        while at < n:
            at = 2 * at if free[2 * at] >= min(sizes[i], room) else 2 * at + 1
        out[i] = at - n
        free[at] -= sizes[i]
        while at > 1:
            at //= 2
            free[at] = max(free[2 * at], free[2 * at + 1])
    return out


def packing_plan(spark: SparkSession, path: str, target_bytes: int = TARGET_PARTITION_BYTES,
                 small_bytes: int = SMALL_FILE_BYTES, fmt: str = "parquet") -> DataFrame:
    """``file_path``, ``file_size``, ``folder``, ``bin`` of every small file that
    shares a bin of at most ``target_bytes`` with others of its folder.

    Only the listing is read. Folders are packed apart, in Spark tasks of at most
    about FILES_AT_ONCE files; a folder with more is cut by a hash of the names."""
    small = (list_files(spark, path, f"*.{fmt}").where(F.col("file_size") < small_bytes)
             .where(~F.col("file_path").rlike("/[_.][^/=]*/"))          # hidden folders hold no data
             .withColumn("folder", F.regexp_replace("file_path", "/[^/]*$", "")))
    cuts = small.groupBy("folder").agg(F.ceil(F.count(F.lit(1)) / FILES_AT_ONCE).alias("cuts"))
    small = small.join(cuts, "folder").withColumn("cut", F.pmod(F.xxhash64("file_path"), F.col("cuts")))

    def pack(files: pd.DataFrame) -> pd.DataFrame:
        files = files.sort_values("file_path")
        bins = first_fit_decreasing(files["file_size"].tolist(), target_bytes)
        out = files.assign(bin=[f"{c}-{b}" for c, b in zip(files["cut"], bins)])
        return out[out.groupby("bin")["bin"].transform("size") > 1][["file_path", "file_size", "folder", "bin"]]
    return small.groupBy("folder", "cut").applyInPandas(pack, "file_path string, file_size long, folder string, bin string")


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def compact_folder(spark: SparkSession, path: str, target_bytes: int = TARGET_PARTITION_BYTES,
                   small_bytes: int = SMALL_FILE_BYTES, fmt: str = "parquet") -> DataFrame:
    """Rewrite the small files of a folder as few larger ones, in place, and
    return the packing plan. Larger files, and small ones that would stay alone,
    aren't touched. Partition folders are kept.

    The rows of a bin are written by one task, so a bin becomes one file. New files
    and the list of the old ones first go to a hidden folder, which readers skip;
    then the new ones are moved in and the old ones deleted. A run that ends in
    between is completed by :func:`finish_compactions`, which every call begins with.
    Don't read or write the folder meanwhile.
    """
    finish_compactions(spark, path)
    plan = materialize(packing_plan(spark, path, target_bytes, small_bytes, fmt), "packing-plan")
    bins = plan.select("folder", "bin").distinct()
    number = materialize(bins.withColumn("number", F.row_number().over(_one_row_per_bin()) - 1), "bins")
    n = number.count()
    if not n:
        return plan
    stage = f"{path.rstrip('/')}/_compaction-{uuid.uuid4().hex[:12]}"
    data = spark.read.format(fmt).load(path)
    inner = [c for c in data.columns if c not in _partition_columns(spark, path, data)]
    outer = [c for c in data.columns if c not in inner]
    rows = data.select(F.struct(*[F.col(f"`{c}`") for c in data.columns]).alias("row"), _plain_path(F.col("_metadata.file_path")).alias("file_path"))
    placed = (rows.join(plan.join(number, ["folder", "bin"]).select("file_path", "number"), "file_path")
              .repartitionById(n, F.col("number").cast("int")).select("row.*"))
    if outer:
        write_partitioned(placed, f"{stage}/new", *outer, fmt=fmt)      # a bin lies in one folder
    else:
        placed.write.format(fmt).save(f"{stage}/new")
    plan.select("file_path").write.parquet(f"{stage}/old")        # last: only a whole list makes the run count
    finish_compactions(spark, path)
    return plan


def _one_row_per_bin():
    from pyspark.sql import Window

    return Window.orderBy("folder", "bin")      # one row per new file, not per row of data


def _partition_columns(spark: SparkSession, path: str, data: DataFrame) -> list[str]:
    """The columns that the folder names hold."""
    found = list_files(spark, path).select(F.explode(F.split(F.regexp_replace("file_path", "/[^/]*$", ""), "/")).alias("part"))
    names = {r["name"] for r in found.where(F.col("part").contains("=")).select(F.regexp_extract("part", "^([^=]*)=", 1).alias("name")).distinct().collect()}
    return [c for c in data.columns if c in names]


def finish_compactions(spark: SparkSession, path: str) -> int:
    """Complete or drop what compactions of the folder have left; returns how many were completed."""
    jvm, fs, root = _hadoop(spark, path)
    done = 0
    if not fs.exists(root) or not fs.isDirectory(root):
        return 0
    for status in fs.listStatus(root):
        stage = status.getPath()
        if not stage.getName().startswith("_compaction-"):
            continue
        inside = lambda name, base=stage: jvm.org.apache.hadoop.fs.Path(base, name)
        if fs.exists(inside("old/_SUCCESS")):
            olds = [r["file_path"] for r in spark.read.parquet(inside("old").toString()).collect()]     # names of small files
            new = inside("new")
            files = fs.listFiles(new, True) if fs.exists(new) else None
            while files is not None and files.hasNext():
                file = files.next().getPath()
                if file.getName().startswith(("_", ".")):
                    continue
                folder = file.getParent().toUri().getPath()[len(new.toUri().getPath()):].lstrip("/")
                to = jvm.org.apache.hadoop.fs.Path(root, folder) if folder else root
                fs.mkdirs(to)
                fs.rename(file, jvm.org.apache.hadoop.fs.Path(to, f"{stage.getName()[1:]}-{file.getName()}"))
            for old in olds:
                fs.delete(jvm.org.apache.hadoop.fs.Path(old), False)
            done += 1
        fs.delete(stage, True)
    return done


# ---------------------------------------------------------------------------
# The size of a result before it is written
# ---------------------------------------------------------------------------

SAMPLE_ROWS = 65_536        # encoded by each task, at most
FIRST_PAGE = 20_000         # rows after which Spark's writer decides on a column's dictionary


def _parquet_bytes(table: pa.Table) -> int:
    """Size of a table as one file, columns encoded as Spark's writer does: by
    dictionary only where that makes the first page smaller."""
    coded, page = [], table.slice(0, FIRST_PAGE)
    for name in table.column_names:
        column = page[name]
        if pa.types.is_nested(column.type) or not len(column):
            continue
        distinct = pc.unique(column)
        plain = column.nbytes if pa.types.is_primitive(column.type) else sum(c.nbytes for c in column.chunks)
        index = len(column) * max(1, (len(distinct) - 1).bit_length()) / 8
        if distinct.nbytes + index < plain:
            coded.append(name)
    sink = pa.BufferOutputStream()
    pq.write_table(table, sink, compression="snappy", use_dictionary=coded, store_decimal_as_integer=True)
    return sink.getvalue().size


def encoded_sizes(df: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per partition of ``df``: ``rows``, ``sampled`` rows, the ``bytes`` that those
    take as Parquet, encoded by the task, and ``next_bytes``: what each further row
    adds, from half the sample against the whole (a column's dictionary grows
    slower than the rows). One pass; the sample is spread evenly over the partition
    (every block of rows at first, then every second, every fourth, so that about
    ``sample_rows`` are held)."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, step, seen, size = 0, [], 1, 0, 0
        for batch in batches:
            rows += batch.num_rows
            for at in range(0, batch.num_rows, 1024):
                if seen % step == 0:
                    held.append(batch.slice(at, 1024))
                    size += held[-1].num_rows
                    if size > sample_rows and len(held) > 1:
                        held, step = held[::2], step * 2
                        size = sum(b.num_rows for b in held)
                seen += 1
        if not rows:
            return
        whole, half = pa.Table.from_batches(held), pa.Table.from_batches(held[::2])
        size, further = _parquet_bytes(whole), 0.0
        if size and whole.num_rows < rows:
            further = (size - _parquet_bytes(half)) / (whole.num_rows - half.num_rows) if len(held) > 1 else size / whole.num_rows
        yield pa.RecordBatch.from_pydict({"rows": [rows], "sampled": [whole.num_rows], "bytes": [size], "next_bytes": [float(further)]}, SIZES)
    return df.mapInArrow(encode, "rows long, sampled long, bytes long, next_bytes double")


SIZES = pa.schema([("rows", pa.int64()), ("sampled", pa.int64()), ("bytes", pa.int64()), ("next_bytes", pa.float64())])


def estimate_written(df: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row: ``rows`` (exact), ``bytes`` that ``df`` takes as snappy Parquet in
    as many files as it has partitions, estimated, and ``error``: the standard error
    of that as a share, from how much the partitions' bytes per further row
    differ (0 where all rows were encoded; null if that can't be told, from one
    partition)."""
    left = F.col("rows") - F.col("sampled")
    whole = encoded_sizes(df, sample_rows).agg(
        F.sum("rows").alias("rows"), F.sum(F.col("bytes") + F.col("next_bytes") * left).alias("bytes"),
        F.stddev_samp(F.when(left > 0, F.col("next_bytes"))).alias("sd"), F.sqrt(F.sum(left * left)).alias("left"))
    error = F.when(F.col("left") == 0, F.lit(0.0)).otherwise(F.col("sd") * F.col("left") / F.col("bytes"))
    return whole.select(F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce(F.ceil("bytes"), F.lit(0)).cast("long").alias("bytes"),
                        F.when(F.col("rows").isNotNull(), error).alias("error"))


def size_result_partitions(df: DataFrame, target_bytes: int = TARGET_PARTITION_BYTES, by: str | None = None,
                           of: list[str] | None = None, overhead: int = ROW_OVERHEAD, min_partitions: int = 4) -> DataFrame:
    """``rows``, ``bytes`` in memory and the partition count ``max(min, ceil(bytes /
    target))`` of a result as it is computed, one row or one for each group of
    ``by``: a partially aggregated pass that writes nothing. ``of``: the columns that count."""
    row = row_bytes(df.select(*[F.col(f"`{c}`") for c in of]) if of else df, overhead)
    sizes = df.groupBy(*([by] if by else [])).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row), F.lit(0)).alias("bytes"))
    n = F.greatest(F.lit(min_partitions), F.ceil(F.col("bytes") / F.lit(target_bytes)))
    return sizes.select(*([by] if by else []), "rows", "bytes", n.cast("int").alias("partitions"))


def write_sized(df: DataFrame, path: str, target_bytes: int = TARGET_PARTITION_BYTES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Write ``df`` in files of about ``target_bytes`` each, counted from the
    estimate of its size; ``df`` is read twice, so give a table or a checkpoint."""
    size = estimate_written(df, sample_rows).first()["bytes"]
    return write_compacted(df, path, files=max(1, math.ceil(size / target_bytes)))
