"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every training text: each task sums its batches
into one small array per language, Spark adds those up. The model is a matrix
of log-probabilities (``features`` x languages, a few hundred KB), which
travels with the scoring function; batches are scored in numpy from the hashed
n-grams of all their texts laid end to end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

ORDERS = (1, 2, 3)
FEATURES = 1 << 14
CHUNK = 1 << 20          # characters hashed at a time
UNDETERMINED = "und"


def _features(text: str, features: int) -> Iterator[np.ndarray]:
    """Hashed n-grams of one text (spaces around it), in bounded chunks."""
    text = " " + " ".join(text.lower().split()) + " "
    most = max(ORDERS)
    for i in range(0, len(text), CHUNK):
        part = np.frombuffer(text[i:i + CHUNK + most - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        grams = []
        h = np.zeros(len(part), np.uint32)
        for n in range(1, most + 1):
            if len(part) < n:
                break
            # of the n-grams that start in this chunk
            m = min(len(part) - n + 1, CHUNK)
            h = (h[:m] ^ part[n - 1:n - 1 + m]) * np.uint32(0x9E3779B1)
            if n in ORDERS:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) + np.uint32(n)
                grams.append((mixed >> np.uint32(7)) % np.uint32(features))
        yield np.concatenate(grams) if grams else np.zeros(0, np.uint32)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_prior: np.ndarray       # languages
    log_prob: np.ndarray        # languages x features


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", features: int = FEATURES,
          alpha: float = 0.5) -> Model:
    """Fit on all rows of ``docs`` that have a text and a language.

    The driver receives ``languages x features`` sums and nothing per document.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                into = sums.setdefault(lang, np.zeros(features, np.int64))
                rows[lang] = rows.get(lang, 0) + 1
                for f in _features(text, features):
                    into += np.bincount(f, minlength=features)
        for lang, into in sums.items():
            at = np.flatnonzero(into)
            yield pd.DataFrame({"lang": lang, "feature": np.append(at, -1), "n": np.append(into[at], rows[lang])})

    counted = (docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
               .where("lang is not null and text is not null")
               .mapInPandas(count, "lang string, feature int, n long")
               .groupBy("lang", "feature").agg(F.sum("n").alias("n"))
               .groupBy("lang").agg(F.collect_list(F.struct("feature", "n")).alias("sums")))
    languages, prior, prob = [], [], []
    for row in sorted(counted.toLocalIterator(), key=lambda r: r["lang"]):
        n = np.full(features, alpha)
        for s in row["sums"]:
            if s["feature"] < 0:
                prior.append(np.log(s["n"]))
            else:
                n[s["feature"]] += s["n"]
        languages.append(row["lang"])
        prob.append(np.log(n / n.sum()))
    prior = np.array(prior)
    if len(prior):
        prior -= np.log(np.exp(prior - prior.max()).sum()) + prior.max()
    return Model(tuple(languages), prior, np.array(prob).reshape(len(languages), features))


def predict(text: Column, model: Model) -> Column:
    """Struct (``lang_pred``, ``score``) of a text: the likeliest language and
    its posterior probability. ``und`` with score 0 where the text is null or
    has no letter, or where the model knows no language. Ties go to the first
    language in alphabetical order."""
    languages, prior, prob = model.languages, model.log_prior, model.log_prob
    features = prob.shape[1]

    def score(texts: pd.Series) -> pd.DataFrame:
        lang, value = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        rows, parts, size = [], [], []
        sums = np.zeros((len(texts), len(languages)))

        def flush():
            if parts:
                f, start = np.concatenate(parts), np.concatenate([[0], np.cumsum(size)[:-1]]).astype(int)
                for k in range(len(languages)):
                    np.add.at(sums[:, k], rows, np.add.reduceat(prob[k][f], start))
                rows.clear(), parts.clear(), size.clear()

        known = np.array([bool(languages) and _has_letter(t) for t in texts], bool)
        held = 0
        for i in np.flatnonzero(known):
            for f in _features(texts.iloc[i], features):
                if len(f):
                    rows.append(i), parts.append(f), size.append(len(f))
                    held += len(f)
                if held > CHUNK:
                    flush()
                    held = 0
        flush()
        if known.any():
            total = sums[known] + prior
            best = total.argmax(1)
            value[known] = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
            for i, b in zip(np.flatnonzero(known), best):
                lang[i] = languages[b]
        return pd.DataFrame({"lang_pred": lang, "score": value})

    return F.pandas_udf(score, "lang_pred string, score double")(text)


def identify(docs: DataFrame, train_on: Column, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added (columns of those names
    are replaced); the model is fitted on the rows where ``train_on`` holds.
    The features are the text's n-grams alone."""
    model = train(docs.where(train_on), text_col, lang_col)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept])            # no name can clash
    return docs.select(row.alias("row"), predict(F.col(text_col), model).alias("found")).select("row.*", "found.lang_pred", "found.score")
