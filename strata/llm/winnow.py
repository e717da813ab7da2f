"""Document fingerprints by winnowing.

Every ``k`` consecutive characters are hashed by a rolling polynomial; of each
window of ``window`` consecutive hashes the smallest is chosen, the rightmost
of equal ones. A fingerprint is the chosen hashes with their positions. Two
texts that share ``window + k - 1`` characters in a row share a chosen hash, and
the positions tell where each has it; nothing shorter than ``k`` is matched.

Texts are hashed many at a time: laid end to end in one array with a gap after
each, hashes and window minima are built by doubling, a few passes over the array.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

K, WINDOW = 16, 64
BATCH_CHARS = 1 << 18       # laid end to end at once, unless one text is longer
BASE, SPREAD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93      # odd: rolling base, final mixing
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
MARKS = T.ArrayType(T.StructType([T.StructField("hash", T.LongType()), T.StructField("position", T.IntegerType())]))
FEW = 512                   # texts held as Python strings at once
SAMPLED = 24                # ids looked at for each partition, to deal rows evenly


def _hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Rolling hash of the ``k`` values from each place on (32 bits; the last k - 1 places have none)."""
    done, total = 0, None
    part, size = codes.astype(np.uint64), 1
    while k:                                    # k by its binary digits: runs of 1, 2, 4, ... values
        if k & 1:
            lift = np.uint64(pow(BASE, size, 1 << 64))
            total = part if total is None else total[:len(part) - done] * lift + part[done:]
            done += size
        k >>= 1
        if k:
            part = part[:len(part) - size] * np.uint64(pow(BASE, size, 1 << 64)) + part[size:]
            size *= 2
    mixed = (total ^ (total >> np.uint64(32))) * np.uint64(SPREAD)
    return mixed >> np.uint64(32)


def _window_minima(keys: np.ndarray, window: int) -> np.ndarray:
    """The smallest of the ``window`` keys from each place on."""
    low, size = keys, 1
    while size < window:
        step = min(size, window - size)
        low = np.minimum(low[:len(low) - step], low[step:])
        size += step
    return low


def winnow(texts: list[str], k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(marks of each text, their hashes, their positions), in order of position.
    A text of fewer hashes than ``window`` is one window; one under ``k``
    characters is hashed whole, and an empty one has no marks."""
    counts, hashes, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    at = 0
    while at < len(texts):
        end, size = at + 1, len(texts[at])
        while end < len(texts) and size + len(texts[end]) <= BATCH_CHARS:
            size += len(texts[end])
            end += 1
        for out, x in zip((counts, hashes, places), _winnow(texts[at:end], k, window)):
            out.append(x)
        at = end
    return np.concatenate(counts), np.concatenate(hashes), np.concatenate(places)


def _winnow(texts: list[str], k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    gap = window + k                            # no window of a text reaches the next one's hashes
    blank = "\0" * gap
    codes = np.frombuffer((blank.join(texts) + blank).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(size + gap) - size - gap
    grams = np.maximum(size - k + 1, (size > 0).astype(np.int64))       # hashes of each text
    windows = np.maximum(grams - window + 1, (grams > 0).astype(np.int64))

    def within(length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The text and the place of each of ``length`` places from its start."""
        owner = np.repeat(np.arange(len(texts)), length)
        return owner, np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length) + start[owner]

    owner, place = within(grams)
    keys = np.full(len(codes), NONE)
    # The hash, then the position from the end: of equal hashes the rightmost is smallest.
    keys[place] = _hashes(codes, k)[place] << np.uint64(32) | (np.uint64(0xFFFFFFFF) - (place - start[owner]).astype(np.uint64))
    owner, place = within(windows)
    chosen = _window_minima(keys, window)[place]
    new = np.ones(len(chosen), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
    chosen, owner = chosen[new], owner[new]
    return (np.bincount(owner, minlength=len(texts)), (chosen >> np.uint64(32)).astype(np.int64),
            (np.uint64(0xFFFFFFFF) - (chosen & np.uint64(0xFFFFFFFF))).astype(np.int32))


def fingerprint(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """The marks of a text, in order of position: an array of (hash, position),
    positions in code points. Null and empty texts have none. Equal texts have
    equal fingerprints."""
    @F.arrow_udf(MARKS)
    def marks(texts: pa.Array) -> pa.Array:
        return _marks(texts, k, window)
    return marks(text)


def _marks(texts: pa.Array | pa.ChunkedArray, k: int, window: int) -> pa.Array:
    found = [winnow([t or "" for t in texts.slice(at, FEW).to_pylist()], k, window) for at in range(0, max(len(texts), 1), FEW)]
    count, hashes, places = (np.concatenate(c) for c in zip(*found))
    ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(hashes), pa.array(places)], ["hash", "position"]))


def likeness(a: Column, b: Column) -> Column:
    """Share of the distinct hashes of two fingerprints that both have (0 to 1);
    two empty fingerprints are alike, an empty one and another aren't."""
    left, right = F.transform(a, lambda m: m["hash"]), F.transform(b, lambda m: m["hash"])
    either = F.size(F.array_union(left, right))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(left, right)) / either)


def listing(marks: Column) -> Column:
    """A fingerprint as text: ``hash@position`` (8 hex digits, decimal), joined by commas."""
    one = lambda m: F.concat(F.lpad(F.lower(F.hex(m["hash"])), 8, "0"), F.lit("@"), m["position"].cast("string"))
    return F.array_join(F.transform(marks, one), ",")


def _key(id_value, text_hash: int) -> tuple:
    """Sorts descending by id, null ids last, then by a hash of the text."""
    return (id_value is not None, id_value if id_value is not None else 0, text_hash)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """``id``, ``text``, ``next_text`` of every row, and both texts' fingerprints,
    ``marks`` and ``next_marks``: the next row is the one by descending id, after
    the last the first. Null ids come last; rows of one id follow each other by a
    hash of the text, then by the text. Null texts stay null. A row alone is its
    own next; an empty table gives no rows.

    Rows are dealt to partitions by bounds from a small sample of (id, text
    hash), so neither many rows nor one id's many texts fall into one partition.
    Each partition is sorted and read through once; the first row of every
    partition goes also to the one before it. Texts are shuffled once, and each
    is winnowed once, as it is read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # SAMPLED ids a partition reach the driver, chosen by hash.
    sample = sorted(_key(r["id"], r["h"]) for r in rows.select("id", "h").orderBy(F.xxhash64("id", "h")).limit(n * SAMPLED).collect())
    bounds = sorted({sample[len(sample) * i // n] for i in range(1, n)}) if sample else []

    @F.arrow_udf("int")
    def partition(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        # The largest ids go first: partition 0 holds what lies above the last bound.
        return pa.array([len(bounds) - bisect_left(bounds, _key(i, h)) for i, h in zip(ids.to_pylist(), hashes.to_pylist())], pa.int32())

    dealt = rows.withColumn("part", partition("id", "h"))
    firsts = (dealt.groupBy("part").agg(F.max(F.struct("id", "h")).alias("top"))     # a null id is the smallest
              .orderBy("part").collect())                                            # a row for each partition
    if not firsts:
        none = F.lit(None).cast(MARKS)
        return rows.select("id", "text", F.col("text").alias("next_text"), none.alias("marks"), none.alias("next_marks"))
    # Each partition's first row also goes, as its last, to the one before; the very first to the last one.
    heads = spark.createDataFrame([(firsts[i - 1]["part"], r["top"]["id"], r["top"]["h"]) for i, r in enumerate(firsts)],
                                  T.StructType([T.StructField("part", T.IntegerType()), T.StructField("top_id", docs.schema[id_col].dataType),
                                                T.StructField("top_h", T.LongType())]))
    ahead = (rows.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("top_id")) & (F.col("h") == F.col("top_h")))
             .groupBy("part", "id", "h").agg(F.min("text").alias("text")))            # of rows alike in both, the first
    every = (dealt.withColumn("ahead", F.lit(False))
             .unionByName(ahead.withColumn("ahead", F.lit(True))))
    order = ["part", "ahead", F.col("id").desc_nulls_last(), F.desc("h"), F.asc_nulls_first("text")]
    placed = every.repartitionById(n, F.col("part")).sortWithinPartitions(*order).select("part", "ahead", "id", "text")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with what stands below it; a row without one is dropped
        (only a part's last row, which came from the next part, has none)."""
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, FEW):
                table = pa.Table.from_batches([batch.slice(at, FEW)])
                table = table.append_column("marks", _marks(table["text"], k, window))
                table = table if held is None else pa.concat_tables([held, table])
                held = table.slice(len(table) - 1)
                if len(table) > 1:
                    here, below = table.slice(0, len(table) - 1), table.slice(1)
                    out = pa.table([here["id"], here["text"], below["text"], here["marks"], below["marks"]], names=list(schema.names))
                    yield from out.filter(pc.invert(here["ahead"])).combine_chunks().to_batches()

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("text", T.StringType()),
                           T.StructField("next_text", T.StringType()), T.StructField("marks", MARKS), T.StructField("next_marks", MARKS)])
    return placed.mapInArrow(pair, schema)


def edited(text: Column, next_text: Column) -> Column:
    """A text whose last third (rounded down, in code points) is replaced by as
    many of the next text's first (or all of it). Nulls are empty."""
    text, next_text = F.coalesce(text, F.lit("")), F.coalesce(next_text, F.lit(""))
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(next_text, F.lit(1), third))
