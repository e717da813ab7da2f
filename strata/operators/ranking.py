"""Global ranks without pulling a table into one task.

An unpartitioned window (``row_number() over (order by v)``) plans an
``Exchange SinglePartition``: every row in one task. These operators give the
same numbers with distributed plans:

* :func:`top_k_ranked` - the first ``k`` rows by value, with their
  ``row_number`` and ``percent_rank`` over the *whole* table. Each partition
  passes on its ``k`` best rows (and ``k`` largest distinct values), so the
  merging task receives at most ``k`` x partitions; the table size enters as a
  scalar subquery.
* :func:`global_row_number` - the rank of every row: range partitioning,
  a checkpoint so both uses see the same partitions, per-partition counts
  (one row per partition) turned into offsets, then a broadcast of those
  offsets. The broadcast is bounded by the partition count, not the data.
* :func:`global_percent_rank` - ``percent_rank`` of every row from where its
  value's run begins in that ordering.
* :func:`numbered_within` - the position of every row within its group, for
  groups of any size. Both number the runs of equal rows while the sorted
  partitions are written, so rows are shuffled once; a run that goes on from
  the partition before is corrected by a table of one row per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import reliable_checkpoint

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | row in partition


def _order(value: str, key: str, descending: bool) -> list[Column]:
    v = F.col(value).desc() if descending else F.col(value).asc()
    return [v, F.col(key).asc()]


def top_k_ranked(df: DataFrame, value: str, key: str, k: int = 1000,
                 rank_col: str = "user_rank", pct_col: str = "ltv_percentile",
                 materialize: bool = True) -> DataFrame:
    """Top ``k`` rows by ``value`` desc (ties by ``key`` asc), in that order.

    ``rank_col`` = row_number in that order; ``pct_col`` = percent_rank of the
    value in ascending order over all rows of ``df`` (ties share the lowest
    rank, a single row gives 0.0). To rank everything use
    :func:`global_percent_rank`.

    ``df`` is read three times (the top k, the distinct values, the count);
    with ``materialize`` it is checkpointed first so an expensive upstream
    (e.g. a two-level rollup over the fact table) runs once.
    """
    if materialize:
        df = reliable_checkpoint(df)
    n = df.select(F.count(F.lit(1))).scalar()
    top = df.orderBy(*_order(value, key, True)).limit(k)
    top = top.withColumn(rank_col, F.row_number().over(Window.orderBy(*_order(value, key, True)))
                         .cast("bigint"))
    # Rows with value >= v, for the k largest distinct values: a running sum
    # over at most k rows. Every top-k row's value is among them.
    dv = (df.groupBy(value).agg(F.count(F.lit(1)).alias("_cnt"))
            .orderBy(F.col(value).desc()).limit(k))
    dv = dv.withColumn("_ge", F.sum("_cnt").over(
        Window.orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, 0)))
    pct = F.when(n > 1, (n - F.col("_ge")).cast("double") / (n - 1)).otherwise(F.lit(0.0))
    dv = dv.select(F.col(value).alias("_v"), pct.alias(pct_col))
    # Both sides hold at most k rows. A NULL value sorts first ascending: 0.0.
    out = top.join(F.broadcast(dv), top[value] == dv["_v"], "left").drop("_v")
    return (out.withColumn(pct_col, F.when(F.col(value).isNull(), F.lit(0.0)).otherwise(F.col(pct_col)))
               .orderBy(F.col(rank_col)))


def ranked_partitions(df: DataFrame, order: list[Column], num_partitions: int | None = None) -> DataFrame:
    """Range-partition and sort ``df`` by ``order``, tag each row with its
    ``_mid`` (partition << 33 | position), and checkpoint.

    The order must be total (include a unique key) so ties can be split across
    partitions: a value held by a third of the rows is spread evenly. The
    checkpoint pins the sampled range bounds; without it the two uses below
    could each re-sample and disagree.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *order)
                .sortWithinPartitions(*order)
                .withColumn("_mid", F.monotonically_increasing_id()))
    return reliable_checkpoint(tagged)


def _with_offsets(tagged: DataFrame, rank_col: str, keep_partition: bool = False) -> DataFrame:
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    counts = tagged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid")
                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
         .alias("_off"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    # ``offsets`` has one row per partition: its broadcast is bounded by the
    # partition count, whatever the data size.
    return (tagged.withColumn("_pid", pid)
                  .join(F.broadcast(offsets), "_pid")
                  .withColumn(rank_col, F.col("_off") + local + F.lit(1))
                  .drop("_off", "_mid", *([] if keep_partition else ["_pid"])))


def global_row_number(df: DataFrame, value: str, key: str, descending: bool = True,
                      rank_col: str = "row_number", num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by value [desc], key)`` for every row, distributed."""
    tagged = ranked_partitions(df, _order(value, key, descending), num_partitions)
    return _with_offsets(tagged, rank_col)


def consecutive_ids(df: DataFrame, id_col: str = "id", start: int = 0, pinned: bool = False) -> DataFrame:
    """``df`` with the numbers from ``start`` on, one for each row, as the rows lie:
    no sort and no shuffle, a count per partition (one row each, broadcast) and
    the row's place in its partition. ``df`` is read twice and has to lie alike
    both times, so it is checkpointed first; ``pinned`` tells that it does
    anyway, as the scan of a table."""
    tagged = df.withColumn("_mid", F.monotonically_increasing_id())
    numbered = _with_offsets(tagged if pinned else reliable_checkpoint(tagged), id_col)
    return numbered.withColumn(id_col, F.col(id_col) + F.lit(start - 1))


def _differs(column: pa.ChunkedArray) -> np.ndarray:
    """Whether each value but the first differs from the one before; nulls are alike, and so are NaNs."""
    a, b = column.slice(1), column.slice(0, max(len(column) - 1, 0))
    unequal = pc.fill_null(pc.not_equal(a, b), True).to_numpy().astype(bool)
    both = pc.and_(pc.is_null(a), pc.is_null(b)).to_numpy().astype(bool)
    if pa.types.is_floating(column.type):
        both |= pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False).to_numpy().astype(bool)
    return unequal & ~both


def _with_runs(df: DataFrame, group: list[str], order: list[Column], num_partitions: int | None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, which begins with
    ``group`` and is total, checkpointed with ``_pid`` (partition), ``_place``
    (from 0) and ``_local``: the place (from 1) within the run of rows alike in
    ``group``. Numbered as the sorted rows stream by; a run may be any length."""
    schema = T.StructType([*df.schema.fields, T.StructField("_pid", T.IntegerType()), T.StructField("_place", T.LongType()), T.StructField("_local", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, place, local, last = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            here = pa.Table.from_batches([batch]).select(group)
            run = pa.concat_tables([last, here]) if last is not None else here
            new = np.zeros(len(run) - 1, bool)
            for c in group:
                new |= _differs(run[c])
            new = new if last is not None else np.append(True, new)
            at = np.arange(n)
            # A run that began in an earlier batch began ``local`` rows before this one.
            first = np.maximum.accumulate(np.where(new, at, -local))
            count = at - first + 1
            out = [*batch.columns, pa.array(np.full(n, pid, np.int32)), pa.array(place + at), pa.array(count)]
            yield pa.RecordBatch.from_arrays(out, schema=pa.schema([*batch.schema, ("_pid", pa.int32()), ("_place", pa.int64()), ("_local", pa.int64())]))
            place, local, last = place + n, int(count[-1]), here.slice(n - 1)

    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return reliable_checkpoint(df.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(number, schema))


def _carried(tagged: DataFrame, group: list[str]) -> tuple[DataFrame, int]:
    """(``_pid``, ``_off``: rows before the partition, ``_carry``: rows of its
    first run that lie before it), one row for each partition, and the rows of all."""
    key = F.struct(*group)
    ends = tagged.groupBy("_pid").agg(
        (F.max("_place") + 1).alias("n"), F.min_by(key, "_place").alias("first"), F.max_by(key, "_place").alias("last"),
        F.max_by("_local", "_place").alias("run")).orderBy("_pid")
    alike = F.coalesce(F.col("first").eqNullSafe(F.lag("last").over(Window.orderBy("_pid"))), F.lit(False))     # one row per partition
    rows, before, carry, out = ends.withColumn("goes_on", alike & (F.col("_pid") > 0)).select("_pid", "n", "run", "goes_on").collect(), 0, 0, []
    run = whole = None
    for r in rows:
        # What the last run had: its rows in that partition, and those before it if it filled the partition.
        carry = (run + (carry if whole else 0)) if r["goes_on"] else 0
        out.append((r["_pid"], before, carry))
        before, run, whole = before + r["n"], r["run"], r["run"] == r["n"]
    return tagged.sparkSession.createDataFrame(out, "_pid int, _off long, _carry long"), before


def global_percent_rank(df: DataFrame, value: str, key: str, pct_col: str = "percent_rank",
                        rank_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """``percent_rank() over (order by value)`` for every row, distributed;
    ``rank_col`` adds ``row_number() over (order by value desc, key)``.

    Rows are sorted by value across range partitions; a row's rank is the place
    where its value's run begins. Only the first run of a partition may begin
    in an earlier one, which one row per partition tells. NULL comes first: 0.
    """
    order = [F.col(value).asc_nulls_first(), F.col(key).desc_nulls_last()]      # the reverse of value desc, key asc
    tagged = _with_runs(df, [value], order, num_partitions)
    parts, n = _carried(tagged, [value])
    out = tagged.join(F.broadcast(parts), "_pid")
    place = F.col("_off") + F.col("_place")
    begin = place - (F.col("_local") - 1) - F.when(F.col("_local") == F.col("_place") + 1, F.col("_carry")).otherwise(F.lit(0))
    out = out.withColumn(pct_col, begin / F.lit(float(n - 1)) if n > 1 else F.lit(0.0))
    if rank_col:
        out = out.withColumn(rank_col, F.lit(n) - place)
    return out.drop("_pid", "_place", "_local", "_off", "_carry")


def numbered_within(df: DataFrame, group: list[str], order: list[str], position_col: str = "position",
                    num_partitions: int | None = None) -> DataFrame:
    """Position (from 1) of every row within its group, NULL keys forming groups
    like any other. ``order`` has to make the order total.

    Rows are range-partitioned by (group, order), so a group of any size is
    spread evenly, and numbered within the runs that groups form there. The first
    run of a partition may have begun earlier, and goes on from there: one row
    per partition, broadcast.
    """
    tagged = _with_runs(df, group, [F.col(c).asc() for c in (*group, *order)], num_partitions)
    parts, _ = _carried(tagged, group)
    earlier = F.when(F.col("_local") == F.col("_place") + 1, F.col("_carry")).otherwise(F.lit(0).cast("long"))
    return (tagged.join(F.broadcast(parts), "_pid").withColumn(position_col, F.col("_local") + earlier)
            .drop("_pid", "_place", "_local", "_off", "_carry"))
