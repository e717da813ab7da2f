"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark.

Texts are shuffled once, into blocks of about a megabyte. A block hashes all
its windows and sends each distinct hash once, to the bucket its leading bits
name: a request of 7 bytes per hash, however often a hash repeats in the
block. A bucket counts the blocks of each hash and answers with one bit per
hash, in the order asked. A block joins the answers with its own counts.

Windows that seem repeated go through a second round with another hash
function, so that a window counts as repeated only if both its 64-bit hashes
are; what remains is merged into maximal intervals. Neither a text nor a window
position travels through the counting.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20      # of text whose hashes share a bucket
MIN_BUCKETS = 256           # so that the first byte of a hash is known from its bucket

# Odd multipliers of each round's hash, over the bytes of a word and over words.
BASES = ((0x9E3779B97F4A7C15, 0xD1342543DE82EF95), (0xBF58476D1CE4E5B9, 0x2545F4914F6CDD1D))


@lru_cache(maxsize=8)
def _powers_of(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < size."""
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(size, b, np.uint64)
        p[:1] = 1
        both.append(np.cumprod(p))
    return both[0], both[1]


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1 << 20, 1 << max(n - 1, 0).bit_length())
    up, down = _powers_of(base, size)
    return up[:n], down[:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _rolling(values: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash modulo 2^64 of values[start:end], from prefix sums."""
    up, down = _powers(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=prefix[1:])
    return (prefix[end] - prefix[start]) * down[start]


def split_words(data: bytes | None) -> list[bytes]:
    return (data or b"").split()    # of bytes: at ASCII white space alone


def window_hashes(docs: list[list[bytes]], window: int, turn: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every window of every document, by the hash function of a
    round, and where each starts among the words of all documents laid end to end."""
    byte_base, word_base = BASES[turn]
    words = [w for d in docs for w in d]
    n = len(words)
    size = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(size)
    letters = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    token = _mix(_rolling(letters, byte_base, end - size, end) ^ (size.astype(np.uint64) << np.uint64(40)))
    close = np.repeat(np.cumsum([len(d) for d in docs]), [len(d) for d in docs]) if n else np.zeros(0, np.int64)
    start = np.flatnonzero(np.arange(n) + window <= close)
    return _mix(_rolling(token, word_base, start, start + window)), start


def _repeated(h: np.ndarray, shift: int, buckets, bits) -> np.ndarray:
    """Which of a block's hashes occur elsewhere: in the block itself, or in
    another one by the answers to its distinct hashes."""
    known, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    twice, bucket = count > 1, (known >> np.uint64(shift)).astype(np.int64)
    for k, b in zip(buckets, bits):
        lo, hi = np.searchsorted(bucket, [k, k + 1])
        twice[lo:hi] |= np.unpackbits(np.frombuffer(b, np.uint8), count=hi - lo).astype(bool)
    return twice[inverse]


def _doubtful(docs: list[list[bytes]], window: int, shift: int, answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Second hashes and starts of the windows that the first round found repeated."""
    h, start = window_hashes(docs, window)
    first = answers[answers["turn"] == 0]
    kept = _repeated(h, shift, first["bucket"], first["bits"])
    return (window_hashes(docs, window, 1)[0][kept] if kept.any() else h[:0]), start[kept]


def _request(block: int, turn: int, h: np.ndarray, shift: int) -> pd.DataFrame:
    """A block's distinct hashes by bucket, seven bytes each."""
    h = np.unique(h)
    bucket = (h >> np.uint64(shift)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(h) else np.zeros(0, int)
    low = np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7])
    return pd.DataFrame({"bucket": bucket[cut], "turn": np.full(len(cut), turn), "block": np.full(len(cut), block),
                         "hashes": [low[a:b].tobytes() for a, b in zip(cut, np.append(cut[1:], len(h)))]})


def _ask(window: int, shift: int):
    def ask(rows: pd.DataFrame) -> pd.DataFrame:
        docs = [split_words(t) for t in rows["text"]]
        return _request(rows["block"].iloc[0], 0, window_hashes(docs, window)[0], shift)
    return ask


def _ask_again(window: int, shift: int):
    def ask(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        docs = [split_words(t) for t in rows["text"]]
        h, _ = _doubtful(docs, window, shift, answers)
        return _request(rows["block"].iloc[0] if len(rows) else 0, 1, h, shift)
    return ask


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """One bit per hash asked for: whether another block has it too."""
    size = np.array([len(h) // 7 for h in rows["hashes"]])
    low = np.zeros((size.sum(), 8), np.uint8)
    low[:, :7] = np.frombuffer(b"".join(rows["hashes"]), np.uint8).reshape(-1, 7)
    h = low.view("<u8")[:, 0]
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    out = [(b, n, k, np.packbits(t).tobytes()) for b, n, k, t in zip(
        rows["block"], rows["turn"], rows["bucket"], np.split(twice, np.cumsum(size)[:-1])) if t.any()]
    return pd.DataFrame(out, columns=["block", "turn", "bucket", "bits"])


def _intervals(covered: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _remove(window: int, shift: int, id_col: str):
    def remove(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        docs = [split_words(t) for t in rows["text"]]
        h, start = _doubtful(docs, window, shift, answers)
        second = answers[answers["turn"] == 1]
        at = start[_repeated(h, shift, second["bucket"], second["bits"])]
        n = sum(map(len, docs))
        step = np.zeros(n + 1, np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + window, -1)
        covered = np.cumsum(step)[:n] > 0
        out, first = [], 0
        for key, words in zip(rows["id"], docs):
            gone = covered[first:first + len(words)]
            first += len(words)
            kept = words if not gone.any() else [w for w, g in zip(words, gone.tolist()) if not g]
            out.append((key, len(words), _intervals(gone), b" ".join(kept)))
        return pd.DataFrame(out, columns=[id_col, "n_words", "removed", "kept"])
    return remove


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row of ``docs``: the id, ``n_words``, ``removed`` (maximal intervals
    of word positions, end exclusive) and ``kept`` (the other words joined by a
    space, UTF-8 bytes). A word goes if a window that covers it starts anywhere
    else too, in the same or another row; repeated rows remove each other.

    Texts that are null, blank or shorter than a window lose nothing. An empty
    table gives no rows. Other columns aren't read.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    bits = max(MIN_BUCKETS.bit_length() - 1, (size // bucket_bytes).bit_length())
    text = F.col(text_col).cast("binary")
    rows = docs.select(F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.col(text_col))), F.lit(blocks)).alias("block"),
                       F.col(id_col).alias("id"), text.alias("text"))
    blocked, shift = rows.groupBy("block"), 64 - bits
    request, answer = "bucket long, turn int, block long, hashes binary", "block long, turn int, bucket long, bits binary"
    asked = blocked.applyInPandas(_ask(window, shift), request)
    answered = asked.groupBy("bucket").applyInPandas(_answer, answer)
    doubted = blocked.cogroup(answered.groupBy("block")).applyInPandas(_ask_again(window, shift), request)
    answers = answered.unionByName(doubted.groupBy("bucket").applyInPandas(_answer, answer))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("removed", T.ArrayType(T.StructType([
                               T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
                           T.StructField("kept", T.BinaryType())])
    return blocked.cogroup(answers.groupBy("block")).applyInPandas(_remove(window, shift, id_col), schema)
