"""Token ids of whole texts for a byte-level vocabulary file."""

from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from strata.llm.bpe import byte_alphabet


LONG = 200_000          # code points; tiktoken's pattern matcher runs out of stack in a million white-space characters


class Encoder:
    """Ids as the file's own library gives them without added special tokens:
    the file's vocabulary, whose ids are its merge ranks, run by the faster of
    the two public encoders; texts over LONG code points, which may hold runs
    that the faster one can't take, by the file's own library. Special strings
    inside a text are their ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, vocab = spec["pre_tokenizer"], spec["model"]["vocab"]
        self.path, self._whole = path, None
        plain = not spec["normalizer"] and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if not plain or merged != sorted(merged):
            raise ValueError(f"{path}: not a plain byte-level vocabulary in rank order")
        byte = {c: b for b, c in byte_alphabet().items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in s): i for s, i in vocab.items() if s not in self.special}
        self.core = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens=self.special)

    def encode(self, text: str | None) -> np.ndarray:
        text = text or ""
        if len(text) > LONG:
            if self._whole is None:
                self._whole = Tokenizer.from_file(self.path)
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)
        if any(s in text for s in self.special):
            return np.array(self.core.encode(text, allowed_special="all"), np.uint32)
        return np.array(self.core.encode_ordinary(text), np.uint32)
