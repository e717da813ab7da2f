"""SimHash near-duplicates through an inverted index of fingerprint bytes.

Two 64-bit fingerprints that differ in at most ``d`` bits differ in at most
``d`` of their eight bytes, so they share at least ``8 - d`` (position, byte)
entries: the guaranteed minimum of matches. A list per single entry would hold
1/256 of all rows, so the index is kept per combination of ``8 - d`` entries;
any pair that reaches the minimum meets in the list of its first ``8 - d``
shared entries. There the shared positional bytes of the pair are tallied, the
pair is dropped below the minimum, and the bit distance verifies the rest.

Lists hold distinct fingerprints, so exact copies cost one entry. A long list
isn't expanded into pairs: it yields a spanning star per local component. A
list beyond ``posting_limit`` is split again by the half bytes that its entries
still differ in, which leaves at most ``16 ** d`` fingerprints in a list.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.components import connected_components
from strata.session import materialize

SEED = 42
PAIRWISE = 32          # lists up to this long are compared pair by pair
POSTING_LIMIT = 4096   # longer lists are split by half bytes


def fingerprint(data: bytes | None, shingle: int) -> int:
    """Fingerprint of one text as a signed 64-bit integer (0 without words)."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    k = min(shingle, len(words))
    text = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start, end = (end - length)[:len(words) - k + 1], end[k - 1:]
    tally, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(start), 1 << 16):
        spans = zip(start[i:i + (1 << 16)].tolist(), end[i:i + (1 << 16)].tolist())
        h = np.array([digest(text[a:b], SEED) for a, b in spans], np.uint64)
        tally += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    bits = np.packbits(2 * tally > len(start), bitorder="little")
    return int(bits.view(np.int64)[0])


def simhash(text: Column, shingle: int = 4) -> Column:
    """64-bit SimHash of ``text`` over word shingles, as a long."""
    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return hashed(text.cast("binary"))


def _byte_masks(max_bits: int) -> list[tuple[tuple[int, ...], int]]:
    return [(c, sum(0xFF << 8 * p for p in c)) for c in combinations(range(8), 8 - max_bits)]


def _nibble_masks(kept: tuple[int, ...], max_bits: int) -> list[int]:
    free = [n for p in range(8) if p not in kept for n in (2 * p, 2 * p + 1)]
    base = sum(0xFF << 8 * p for p in kept)
    return [base | sum(0xF << 4 * n for n in c) for c in combinations(free, len(free) - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _stars(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (member, centre) of the components of one list."""
    left, hi, lo = fps, [], []
    while len(left):
        centre, left = left[0], left[1:]
        front = np.array([centre], np.uint64)
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for i in range(0, len(front), 64):
                near |= (np.bitwise_count(front[i:i + 64, None] ^ left[None, :]) <= max_bits).any(0)
            front, left = left[near], left[~near]
            hi.append(front)
            lo.append(np.full(len(front), centre, np.uint64))
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *hi]), np.concatenate([none, *lo])


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    held = None
    for b in batches:
        if held is not None:
            yield False, held
        held = b
    if held is not None:
        yield True, held


def _lists(batches: Iterator[pa.RecordBatch], masks: np.ndarray, limit: int):
    """Whole posting lists from rows (code, fp) sorted by (code, fp & mask):
    yields (codes, fps, list sizes, keys of lists beyond ``limit``). Of a list
    beyond the limit no more than ``limit`` entries and one batch are held."""
    code, fp, skip = np.zeros(0, np.int32), np.zeros(0, np.uint64), None
    for last, rows in _with_last(batches):
        code = np.concatenate([code, rows.column(0).to_numpy(zero_copy_only=False).astype(np.int32)])
        fp = np.concatenate([fp, rows.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        key = fp & masks[code]
        if skip:  # the rest of a list already reported
            keep = (code != skip[0]) | (key != skip[1])
            code, fp, key = code[keep], fp[keep], key[keep]
        if not len(fp):
            continue
        cut = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (key[1:] != key[:-1])]))
        size = np.diff(np.append(cut, len(fp)))
        long = size > limit
        hot = list(zip(code[cut[long]].tolist(), key[cut[long]].tolist()))
        skip = hot[-1] if long[-1] else None
        keep = np.repeat(~long, size)
        code, fp, size = code[keep], fp[keep], size[~long]
        held = 0 if last or skip or not len(size) else int(size[-1])  # the last list may go on
        done = len(fp) - held
        yield code[:done], fp[:done], size[:len(size) - bool(held)], hot
        code, fp = code[done:], fp[done:]


def _links(code, fp, size, owner, first, max_bits):
    """Pairs of fingerprints that link the entries of whole lists."""
    none = np.zeros(0, np.uint64)
    a, b, start = [none], [none], np.cumsum(size) - size
    small = np.repeat((size > 1) & (size <= PAIRWISE), size)
    run, c, f = np.repeat(np.arange(len(size)), size)[small], code[small], fp[small]
    for s in range(1, PAIRWISE):
        at = np.flatnonzero(run[s:] == run[:-s])
        if not len(at):
            break
        x = f[at] ^ f[at + s]
        shared = np.packbits(x.view(np.uint8).reshape(-1, 8) == 0, axis=1, bitorder="little")[:, 0]
        ok = (first[shared] == owner[c[at]]) & (np.bitwise_count(x) <= max_bits)
        a.append(f[at][ok])
        b.append(f[at + s][ok])
    for i in np.flatnonzero(size > PAIRWISE):
        member, centre = _stars(fp[start[i]:start[i] + size[i]], max_bits)
        a.append(member)
        b.append(centre)
    return np.concatenate(a), np.concatenate(b)


def _search(index: DataFrame, masks: list[int], owner: list[int], max_bits: int, limit: int) -> DataFrame:
    """Links and over-long lists of an index of rows (code, fp)."""
    mask, own = np.array(masks, np.uint64), np.array(owner, np.int16)
    first = np.full(256, -1, np.int16)  # set of equal byte positions -> the combination whose list owns the pair
    for s in range(256):
        same = [p for p in range(8) if s >> p & 1]
        if len(same) >= 8 - max_bits:  # the count filter
            first[s] = [c for c, _ in _byte_masks(max_bits)].index(tuple(same[:8 - max_bits]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, fp, size, hot in _lists(batches, mask, limit):
            a, b = _links(code, fp, size, own, first, max_bits)
            a = np.concatenate([a, np.array([k for _, k in hot], np.uint64)]).view(np.int64)
            b = np.concatenate([b.view(np.int64), np.array([c for c, _ in hot], np.int64)])
            if len(a):
                kind = np.arange(len(a)) >= len(a) - len(hot)
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a), pa.array(b)], ["hot", "a", "b"])

    table = F.array(*[F.lit(_signed(m)) for m in masks])
    key = F.col("fp").bitwiseAND(F.get(table, F.col("code")))
    return (index.repartition("code", key).sortWithinPartitions("code", key)
            .mapInArrow(search, "hot boolean, a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4, posting_limit: int = POSTING_LIMIT) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (long) and
    ``component_id``, the smallest id reachable over fingerprints at most
    ``max_bits`` bits apart (0 to 7).

    Null, empty and blank texts have fingerprint 0 and link like any other. A
    row with a null id keeps its fingerprint, has a null component and links
    nothing. Repeated rows stay repeated. Other columns are not read.
    """
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be 0 to 7: beyond that no positional byte is guaranteed to match")
    fps = materialize(docs.select(F.col(id_col).alias("id"), simhash(F.col(text_col), shingle).alias("fp")), "simhash")
    reps = materialize(fps.where("id is not null").groupBy("fp").agg(F.min("id").alias("rep")), "simhash-reps")

    combos = _byte_masks(max_bits)
    index = reps.select(F.explode(F.array(*[F.lit(c) for c in range(len(combos))])).alias("code"), "fp")
    masks = [m for _, m in combos]
    found = materialize(_search(index, masks, list(range(len(combos))), max_bits, posting_limit), "simhash-links")
    links = found.where("not hot").select("a", "b")

    hot = found.where("hot").select(F.col("a").alias("hot_key"), F.col("b").cast("int").alias("hot_code"))
    if not hot.isEmpty():
        finer = [_nibble_masks(c, max_bits) for c, _ in combos]
        per = len(finer[0])
        table = F.array(*[F.lit(_signed(m)) for m in masks])
        split = (index.join(hot, (F.col("code") == F.col("hot_code"))
                            & (F.col("fp").bitwiseAND(F.get(table, F.col("code"))) == F.col("hot_key")))
                 .select(F.explode(F.sequence(F.col("code") * per, F.col("code") * per + (per - 1))).alias("code"), "fp"))
        more = _search(split, [m for f in finer for m in f], [c for c, f in enumerate(finer) for _ in f],
                       max_bits, 16 ** max_bits)
        links = links.unionByName(more.select("a", "b"))

    links = links.distinct()
    ends = [reps.select(F.col("fp").alias(e), F.col("rep").alias("rep_" + e)) for e in "ab"]
    roots = connected_components(links.join(ends[0], "a").join(ends[1], "b"), "rep_a", "rep_b")
    of = materialize(reps.join(roots, reps["rep"] == roots["node"], "left")
                     .select("fp", F.coalesce("component", "rep").alias("component_id")), "simhash-components")
    out = fps.join(of, "fp", "left")
    return out.select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"),
                      F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))
