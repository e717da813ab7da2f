"""Byte-pair encoding of many pre-tokens at once, as ragged numpy arrays.

All symbols of a batch lie end to end in one array, with the number of the
pre-token each belongs to. One round looks up the rank of every adjacent pair,
takes each pre-token's lowest, and merges that pair wherever it occurs in the
pre-token (left to right without overlap). Pre-tokens without a pair that
merges leave the array; the rounds end when it is empty.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import regex

NO_RANK = np.int32(2 ** 31 - 1)


def byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class Merges:
    """The merges of a byte-level vocabulary file, as sorted arrays."""

    def __init__(self, model: dict):
        ids, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        self.width = max(ids.values()) + 1
        key = left * self.width + right
        order = np.argsort(key, kind="stable")
        self.key = np.append(key[order], np.int64(2 ** 62))
        self.rank = np.append(order, NO_RANK).astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        letters = byte_alphabet()
        self.byte = np.array([ids[letters[b]] for b in range(256)], np.int32)
        self.last_byte = np.array([ids[letters[b] + suffix] for b in range(256)], np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.key, key)
        return np.where(self.key[at] == key, self.rank[at], NO_RANK)

    def count(self, pretokens: list[bytes]) -> np.ndarray:
        """Symbols that are left of each (non-empty) pre-token."""
        size = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        raw = np.frombuffer(b"".join(pretokens), np.uint8)
        symbol, word = self.byte[raw], np.repeat(np.arange(len(size)), size)
        end = np.cumsum(size) - 1
        symbol[end] = self.last_byte[raw[end]]
        left = size.copy()
        rank = np.full(len(symbol), NO_RANK, np.int32)   # of the pair that starts here
        pair = word[1:] == word[:-1]
        rank[:-1][pair] = self.ranks(symbol[:-1][pair], symbol[1:][pair])
        while len(symbol):
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            length = np.diff(np.append(start, len(word)))
            best = np.minimum.reduceat(rank, start)
            live = np.repeat(best != NO_RANK, length)
            hit = live & (rank == np.repeat(best, length))
            hit = _leftmost(hit)
            at = np.flatnonzero(hit)
            symbol[at] = self.merged[rank[at]]
            gone = np.zeros(len(symbol), bool)
            gone[at + 1] = True
            np.subtract.at(left, word[at], 1)
            keep = live & ~gone
            new = np.cumsum(keep) - 1
            touched = new[at]
            symbol, word, rank = symbol[keep], word[keep], rank[keep]
            near = np.zeros(len(symbol), bool)             # pairs with a new symbol at either end
            near[touched] = True
            near[touched[touched > 0] - 1] = True
            redo = np.flatnonzero(near)
            rank[redo] = NO_RANK
            redo = redo[redo + 1 < len(word)]
            redo = redo[word[redo] == word[redo + 1]]
            rank[redo] = self.ranks(symbol[redo], symbol[redo + 1])
        return left


def _leftmost(hit: np.ndarray) -> np.ndarray:
    """Of each run of adjacent hits (one pair overlapping itself, as in aaa),
    every second, from the left."""
    at = np.flatnonzero(hit)
    if not len(at):
        return hit
    first = np.concatenate([[True], np.diff(at) != 1])
    begin = np.maximum.accumulate(np.where(first, at, 0))
    out = np.zeros_like(hit)
    out[at[(at - begin) % 2 == 0]] = True
    return out


class WordCounter:
    """Token counts of texts for a vocabulary file of the kind that splits
    texts by a pattern and drops what lies between pre-tokens."""

    CACHE = 1 << 19         # pre-tokens remembered in a task
    BATCH = 1 << 17         # new pre-tokens merged at once
    CHUNK = 1 << 20         # characters of a long text tokenized at a time
    TOGETHER = 1 << 22      # characters whose new pre-tokens are learned together

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if len(split) != 1 or steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: not a vocabulary of this kind")
        self.pattern = regex.compile(split[0], regex.V0)
        self.merges = Merges(spec["model"])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special)))
        self.opening = special[0][:2]
        self.known: dict[str, int] = {}

    def _pretokens(self, text: str) -> list[str]:
        # Lower case character by character: no final-sigma rule.
        plain = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return self.pattern.findall(plain)

    def _learn(self, now: set[str]) -> None:
        new = list(now - self.known.keys())
        if len(self.known) + len(new) > self.CACHE:     # keep what this batch uses
            self.known = {p: self.known[p] for p in now & self.known.keys()}
        for i in range(0, len(new), self.BATCH):
            part = new[i:i + self.BATCH]
            n = self.merges.count([p.encode("utf-8", "replace") for p in part])
            self.known.update(zip(part, n.tolist()))

    def _units(self, texts: list[str | None]) -> Iterator[tuple[int, str]]:
        """(text, part) for parts that are tokenized alone: texts cut around
        special strings, long ones also at a space about every CHUNK characters
        (no pre-token and no composed character spans a space)."""
        for i, text in enumerate(texts):
            for part in self.special.split(text) if text and self.opening in text else [text or ""]:
                start = 0
                while len(part) - start > self.CHUNK and (cut := part.find(" ", start + self.CHUNK)) >= 0:
                    yield i, part[start:cut]
                    start = cut
                yield i, part[start:]

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text: special strings count one, the rest is cut
        around them into pre-tokens, whose counts are computed once."""
        total = [len(self.special.findall(t)) if t and self.opening in t else 0 for t in texts]

        def add(units: list[tuple[int, str]]) -> None:
            pieces = [self._pretokens(part) for _, part in units]
            self._learn(set().union(*pieces))
            for (i, _), p in zip(units, pieces):
                total[i] += sum(map(self.known.__getitem__, p))

        held, size = [], 0
        for unit in self._units(texts):
            held.append(unit)
            size += len(unit[1])
            if size > self.TOGETHER:
                add(held)
                held, size = [], 0
        add(held)
        return total
