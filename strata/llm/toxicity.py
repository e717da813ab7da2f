"""Toxicity by weak supervision.

1. A lexicon is learned from all labelled training rows: words, and beginnings
   of words, that toxic texts hold far more often than others. A key counts by
   what it adds: rows that a stronger key explains say nothing for a weaker one,
   so words that merely stand beside toxic ones stay out at every size.
2. Voters look for it in different ways: several lexicons, word beginnings,
   and patterns of disguise (digits for letters, spaced, stretched, masked and
   shouted words), each of which fires or doesn't on a text.
3. A generative label model explains the voters' joint firings, counted over
   all training documents: a hidden label, each voter's accuracy under it, and
   correlations between voters as a spanning forest. Given labels take part as
   one more voter that may abstain and may err. It is fitted by EM.
4. A linear classifier on lexicon and pattern features is trained on the label
   model's posteriors of a bounded sample of those rows.

Texts meet their labels once, in a shuffle join at every size; a filter of the
labelled ids, of bounded size, keeps other texts out of it. Every text is read
for its features once; voting and scoring work on those.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.bloom import bloom_filter
from strata.session import materialize

LETTER = r"[^\W\d_]"
WORD = re.compile(LETTER + "+")
SPACED = re.compile(rf"(?<!{LETTER}){LETTER}(?:[ .*_-]{LETTER}){{3,}}(?!{LETTER})")
STRETCHED = re.compile(rf"({LETTER})\1\1+")
MIXED = re.compile(r"(?<!\S)[^\s0-9@$!]*+[0-9@$!]\S*")       # words with a digit or sign
MASKED = re.compile(rf"(?<!{LETTER}){LETTER}++[*#]{{1,4}}{LETTER}+")
LEET = str.maketrans("013457@$!", "oieastasi")
EDGE = ".,;:?!\"'()[]*#-_"
BEGIN = 5               # letters of a word's beginning
LEXICONS, STEM_VOTERS, PATTERNS = 6, 2, ("leet", "spaced", "stretched", "masked", "shouted", "several")
KEYS_HELD = 200_000     # counted in a task's memory before they are sent on
AT_ONCE = 1024          # keys held against each other in a round; there is no limit to the rounds
KEY_BITS = 1 << 22      # of the filter of keys that are counted over clean rows; other keys may only add to what is counted
LABEL_BITS = 1 << 21    # of the filter of labelled ids, at most; other texts may only add to what is joined
SAMPLE_ROWS = 30_000    # labelled rows that the classifier is learned from, at most
CELL = np.dtype([("at", "<u4"), ("n", "<f4")])     # a feature's place and count


def keys(text: str) -> set[str]:
    """Words of a text in lower case, the beginnings (``begin*``) of longer ones,
    and those that begin several (``begin**``)."""
    words = WORD.findall(text.lower())
    begins = Counter([w[:BEGIN] for w in words if len(w) > BEGIN])
    return {*words, *[b + "*" for b in begins], *[b + "**" for b, n in begins.items() if n > 1]}


def contexts(text: str, rank: dict[str, int]) -> set[tuple[int, int]]:
    """(rank of a key, hash of its word and the words beside it) of every place of a key."""
    words, out = WORD.findall(text.lower()), set()
    for i, w in enumerate(words):
        begin = w[:BEGIN]
        for key in (w, begin + "*", begin + "**") if len(w) > BEGIN else (w,):
            if key in rank:
                near = " ".join(words[max(i - 1, 0):i + 2])
                out.add((rank[key], xxhash.xxh64_intdigest(f"{w} {near}") >> 1))
    return out


class Features:
    """Counts of each learned key, then of each pattern. ``gains``: how surely
    each key marks toxic texts; keys are in falling order of it."""

    def __init__(self, names: tuple[str, ...], gains: tuple[float, ...] | None = None):
        self.names = names
        stem = np.array([x.endswith("*") for x in names], bool)
        gain = np.array(gains if gains is not None else [1.0] * len(names))
        voter = np.zeros(len(names), int)
        for mine, first, n in ((~stem, 0, LEXICONS), (stem, LEXICONS, STEM_VOTERS)):
            # Bands of like strength and equal sums of it: the many weak keys share the last voters.
            before = np.cumsum(gain[mine]) - gain[mine]
            voter[mine] = first + (n * before / max(gain[mine].sum(), 1e-9)).astype(int)
        self._voter = np.append(voter, LEXICONS + STEM_VOTERS + np.arange(len(PATTERNS)))
        self._words = {n for n in names if not n.endswith("*")}
        self._shapes = {(w[0], w[-1], len(w)) for w in self._words}
        self._finder = None

    def __getstate__(self):
        return {**self.__dict__, "_finder": None}

    def _find(self) -> ahocorasick.Automaton:
        """All keys at once; built in each process, as a task needs it."""
        if self._finder is None:
            entries: dict[str, list] = {}
            for i, n in enumerate(self.names):
                entries.setdefault(n.rstrip("*"), []).append((i, len(n.rstrip("*")), n.endswith("*")))
            self._several = [i for i, n in enumerate(self.names) if n.endswith("**")]
            self._finder = ahocorasick.Automaton()
            for word, values in entries.items():
                self._finder.add_word(word, values)
            self._finder.make_automaton()
        return self._finder

    def found(self, text: str | None) -> dict[int, float]:
        """The counts that aren't zero, by place."""
        text = text or ""
        low = text.lower()
        out: dict[int, float] = {}
        shouted, lexicon = 0, self._words
        for end, values in self._find().iter(low) if self.names else ():
            goes_on = low[end + 1:end + 2].isalpha()
            for i, size, begins in values:
                start = end + 1 - size
                if begins == goes_on and not (start and low[start - 1].isalpha()):
                    out[i] = out.get(i, 0) + 1
                    shouted += len(low) == len(text) and not begins and text[start:end + 1].isupper()
        for i in self._several if out else ():
            if out.get(i) == 1:
                del out[i]
        raw = {"leet": sum(t.strip(EDGE).translate(LEET) in lexicon or t.rstrip(EDGE).translate(LEET) in lexicon
                           for t in MIXED.findall(low) if t.strip(EDGE) not in lexicon),
               "spaced": sum(re.sub(r"[ .*_-]", "", t) in lexicon for t in SPACED.findall(low)),
               "stretched": sum(bool({STRETCHED.sub(r"\1", w), STRETCHED.sub(r"\1\1", w)} & lexicon)
                                for w in WORD.findall(low) if STRETCHED.search(w)) if STRETCHED.search(low) else 0,
               "masked": sum((m[0], m[-1], len(m)) in self._shapes for m in MASKED.findall(low))
               if "*" in low or "#" in low else 0,
               "shouted": 0 if text.isupper() else shouted,
               "several": int(len(out) > 2)}
        return out | {len(self.names) + j: raw[p] for j, p in enumerate(PATTERNS) if raw[p]}

    def of(self, text: str | None) -> np.ndarray:
        out = np.zeros(len(self.names) + len(PATTERNS), np.float32)
        for i, n in self.found(text).items():
            out[i] = n
        return out

    def votes(self, row: np.ndarray, cells: np.ndarray, n: int) -> np.ndarray:
        """Which voters fire (``n`` rows x voters): keys are dealt to the lexicons by strength."""
        out = np.zeros((n, VOTERS), bool)
        out[row, self._voter[cells["at"]]] = True
        return out


VOTERS = LEXICONS + STEM_VOTERS + len(PATTERNS)


def gain_of(a, b, t, c):
    """Likelihood ratio (G) of a key in ``a`` of ``t`` toxic and ``b`` of ``c``
    clean rows; 0 where it doesn't mark toxic ones."""
    a, b = np.asarray(a, float), np.asarray(b, float)
    share, other = (a + b) / (t + c), (t + c - a - b) / (t + c)
    out = np.zeros(a.shape)
    with np.errstate(divide="ignore", invalid="ignore"):
        for seen, of, p in ((a, t, share), (b, c, share), (t - a, t, other), (c - b, c, other)):
            out += np.where(seen > 0, 2 * seen * np.log(seen / (of * p)), 0.0)
        return np.where(a * c > b * t, out, 0.0)


def _counted(known: frozenset[str], wanted: np.ndarray | None):
    """Pandas function: (key, rows that hold it) over rows without a known key,
    and their number as the key "". ``wanted``: a filter of the keys to count."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def rows() -> pd.DataFrame:
            at = [k for k in seen if wanted is None or not k or wanted[xxhash.xxh64_intdigest(k, 42) % KEY_BITS]]
            out = pd.DataFrame({"key": pd.Series(at, dtype=object), "n": pd.Series([seen[k] for k in at], dtype="int64")})
            seen.clear()
            return out
        for batch in batches:
            for text in batch["text"]:
                found = keys(text or "")
                if known.isdisjoint(found):
                    seen.update(found)
                    seen[""] += 1
                if len(seen) > KEYS_HELD:
                    yield rows()
        yield rows()
    return count


def _strongest(known: frozenset[str], rank: dict[str, int]):
    """Pandas function: for each rank, the rows (toxic, clean) whose strongest
    key it is, over rows without a known key; rank -1: rows without any. Rows with a
    ``context`` stand for a place where a toxic row holds the key."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        places: set[tuple[int, int]] = set()

        def listed() -> pd.DataFrame:
            out = pd.DataFrame(sorted(places), columns=["rank", "context"], dtype="int64").assign(a=0, b=0)
            places.clear()
            return out
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found = keys(text or "")
                if known.isdisjoint(found):
                    mine = [rank[k] for k in found if k in rank]
                    seen[min(mine, default=-1), toxic] += 1
                    if toxic and mine:
                        places |= contexts(text, rank)
                if len(places) > KEYS_HELD:
                    yield listed()
        yield listed()
        at = sorted({r for r, _ in seen})
        yield pd.DataFrame({"rank": at, "context": pd.Series([None] * len(at), dtype="Int64"), "a": [seen[r, 1] for r in at], "b": [seen[r, 0] for r in at]})
    return count


def learn_keys(train: DataFrame, least: float = 8.0) -> dict[str, float]:
    """Keys that mark toxic texts, with their likelihood ratios, surest first.
    ``train``: (``text``, ``toxic``), of which all rows count.

    In rounds: of the keys whose ratio over the rows left exceeds ``least`` + 2 ln
    (keys tested), the AT_ONCE surest are held against each other. Every row goes
    to the strongest of them that it holds. A key stays if the ratio also holds
    over its own rows and those that no stronger kept key explains, or if it has
    half the ratio of the strongest and stands beside other words in half of its
    rows at least (toxic words come together, but the words around them only in
    copies of a text). Rows with a kept key are left out of the next round; the
    rounds end when none is kept. No key is dropped for the number of keys.
    """
    known: dict[str, float] = {}
    toxic, clean = train.where("toxic = 1").select("text"), train.where("toxic = 0").select("text")
    all_clean = clean.count()
    while True:
        skip = frozenset(known)
        a = materialize(toxic.mapInPandas(_counted(skip, None), "key string, n long").groupBy("key").agg(F.sum("n").alias("a")), "toxic-keys")
        t = (a.where("key = ''").agg(F.sum("a")).first()[0] or 0)
        tested = max(a.count() - 1, 1)
        floor = least + 2 * np.log(tested)
        if not t or not all_clean:
            break
        # The fewest toxic rows with which a key that no clean row holds passes.
        fewest = next((n for n in range(1, t + 1) if gain_of(n, 0, t, all_clean) >= floor), None)
        if fewest is None:
            break
        may = a.where((F.col("a") >= fewest) & (F.col("key") != ""))
        at = F.pmod(F.xxhash64("key"), F.lit(KEY_BITS).cast("long"))
        # At most KEY_BITS / 64 rows.
        words = (may.select(at.alias("at")).groupBy(F.expr("at div 64").alias("word"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("v")).collect())
        packed = np.zeros(KEY_BITS // 64, np.int64)
        packed[[r["word"] for r in words]] = [r["v"] for r in words]
        wanted = np.unpackbits(packed.view(np.uint8), bitorder="little").astype(bool)
        b = clean.mapInPandas(_counted(skip, wanted), "key string, n long").groupBy("key").agg(F.sum("n").alias("b"))
        both = materialize(a.where((F.col("a") >= fewest) | (F.col("key") == "")).join(b, "key", "left").select("key", "a", F.coalesce("b", F.lit(0)).alias("b")), "toxic-key-counts")
        c = both.where("key = ''").select("b").first()
        c = c["b"] if c else 0
        if not c:
            break
        ratio = F.pandas_udf(lambda x, y: pd.Series(gain_of(x, y, t, c)), "double")
        best = (both.where("key <> ''").withColumn("gain", ratio("a", "b")).where(F.col("gain") >= floor)
                .orderBy(F.desc("gain"), "key").limit(AT_ONCE).collect())
        rank = {r["key"]: i for i, r in enumerate(best)}
        if not rank:
            break
        # A row for each key held, at most AT_ONCE + 1.
        own = {r["rank"]: (r["a"], r["b"], r["places"]) for r in train.select("text", "toxic")
               .mapInPandas(_strongest(skip, rank), "rank int, context long, a long, b long")
               .groupBy("rank", "context").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
               .groupBy("rank").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count("context").alias("places")).collect()}
        kept = {}
        for i, r in enumerate(best):
            x, y, places = own.get(i, (0, 0, 0))
            if gain_of(x, y, t, c) >= floor or 2 * r["gain"] >= best[0]["gain"] and 2 * places >= r["a"]:
                kept[r["key"]] = float(r["gain"])
                t, c = t - x, c - y
        if not kept:
            break
        known |= kept
    return dict(sorted(known.items(), key=lambda x: (-x[1], x[0])))


class LabelModel:
    """Hidden label y; votes given y form a forest: each voter depends on y and
    on at most one other voter. Fitted by EM on counted vote patterns."""

    def __init__(self, votes: np.ndarray, given: np.ndarray, count: np.ndarray, rounds: int = 50):
        """``votes``: patterns x voters; ``given``: label 1, 0, or -1 (none)."""
        v, n = votes.astype(float), count.astype(float)
        p = np.where(given >= 0, 0.02 + 0.96 * (given == 1), 0.0)
        known = given >= 0
        # Without a label: start from how often such votes came with one.
        rate = [(np.bincount(votes[known, j].astype(int), (n * (given == 1))[known], 2) + .5)
                / (np.bincount(votes[known, j].astype(int), n[known], 2) + 1) for j in range(v.shape[1])]
        start = np.mean([r[votes[:, j].astype(int)] for j, r in enumerate(rate)], axis=0)
        p = np.where(known, p, start)
        self.parent = np.full(v.shape[1], -1)
        for i in range(rounds):
            if i in (0, 5):
                self.parent = self._forest(v, n, p)
            self._fit(v, given, n, p)
            new = self.posterior(votes, given)
            if np.abs(new - p).max() < 1e-6 and i > 5:
                break
            p = new

    @staticmethod
    def _forest(v: np.ndarray, n: np.ndarray, p: np.ndarray, least: float = 1e-3) -> np.ndarray:
        """Maximum spanning forest of the voters' mutual information given y."""
        k = v.shape[1]
        info = np.zeros((k, k))
        for w in (n * p, n * (1 - p)):
            total = w.sum() + 1e-9
            on = (v * w[:, None]).sum(0) / total
            both = (v * w[:, None]).T @ v / total
            cells = ((both, on[:, None], on[None]), (on[:, None] - both, on[:, None], 1 - on[None]),
                     (on[None] - both, 1 - on[:, None], on[None]),
                     (1 - on[:, None] - on[None] + both, 1 - on[:, None], 1 - on[None]))
            for joint, x, y in cells:
                joint = np.maximum(joint, 1e-12)
                info += total / n.sum() * joint * np.log(joint / np.maximum(x * y, 1e-12))
        parent, root = np.full(k, -1), np.arange(k)
        edges = sorted(((info[i, j], i, j) for i in range(k) for j in range(i) if info[i, j] > least), reverse=True)
        links: dict[int, list[int]] = {i: [] for i in range(k)}
        for _, i, j in edges:
            if root[i] != root[j]:
                root[root == root[i]] = root[j]
                links[i].append(j)
                links[j].append(i)
        seen = set()
        for i in range(k):
            stack = [i] if i not in seen else []
            while stack:
                x = stack.pop()
                seen.add(x)
                for y in links[x]:
                    if y not in seen:
                        parent[y] = x
                        stack.append(y)
        return parent

    def _fit(self, v, given, n, p) -> None:
        weight = np.stack([n * (1 - p), n * p])                     # by y
        self.prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        k = v.shape[1]
        self.fire = np.zeros((2, 2, k))                              # y, vote of the parent, voter
        for j in range(k):
            above = v[:, self.parent[j]] if self.parent[j] >= 0 else np.zeros(len(v))
            for s in (0, 1):
                w = weight * (above == s)
                self.fire[:, s, j] = ((w * v[:, j]).sum(1) + 0.1) / (w.sum(1) + 0.2)
        seen = weight * (given >= 0)
        self.label = np.clip(((seen * (given == 1)).sum(1) + 0.1) / (seen.sum(1) + 0.2), 0.001, 0.999)

    def posterior(self, votes: np.ndarray, given: np.ndarray) -> np.ndarray:
        """P(y = 1) of each row."""
        above = np.where(self.parent >= 0, votes[:, self.parent], False).astype(int)
        log = np.tile(np.log(self.prior), (len(votes), 1))
        voter = np.arange(votes.shape[1])
        for y in (0, 1):
            f = self.fire[y][above, voter[None]]
            log[:, y] += np.log(np.where(votes, f, 1 - f)).sum(1)
            q = self.label[y]
            log[:, y] += np.select([given == 1, given == 0], [np.log(q), np.log(1 - q)], 0.0)
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))


def fit_linear(row: np.ndarray, cells: np.ndarray, d: int, p: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft labels by Newton's method, each step solved by
    conjugate gradients, from the cells of ``len(p)`` rows and ``d`` features; the
    last weight is the intercept."""
    at, x, n = cells["at"], _scaled(cells), len(p)
    times = lambda v: np.bincount(row, x * v[at], n) + v[-1]
    back = lambda r, x=x: np.append(np.bincount(at, x * r[row], d), r.sum())
    w, penalty = np.zeros(d + 1), np.append(np.full(d, ridge), 1e-6)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(times(w), -30, 30)))
        curve = q * (1 - q)
        scale = back(curve, x * x) + penalty + 1e-9
        step, left = np.zeros(d + 1), penalty * w + back(q - p)
        goal, z = 1e-8 * np.abs(left).max(), left / scale
        way, size = z, left @ z
        for _ in range(200):
            if np.abs(left).max() <= goal:
                break
            bent = back(curve * times(way)) + (penalty + 1e-9) * way
            far = size / (way @ bent)
            step, left = step + far * way, left - far * bent
            z = left / scale
            size, before = left @ z, size
            way = z + size / before * way
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _scaled(cells: np.ndarray) -> np.ndarray:
    return np.log1p(cells["n"].astype(np.float64))


def _packed(found: dict[int, float]) -> bytes:
    return np.array(sorted(found.items()), CELL).tobytes()


def _cells(packed) -> tuple[np.ndarray, np.ndarray]:
    """The row of each cell, and the cells."""
    return (np.repeat(np.arange(len(packed)), [len(b) // CELL.itemsize for b in packed]),
            np.frombuffer(b"".join(packed), CELL))


@dataclass(frozen=True)
class Classifier:
    features: Features
    weights: np.ndarray | None

    def packed(self, text: Column) -> Column:
        """A text's features, as bytes."""
        features = self.features
        return F.pandas_udf(lambda texts: pd.Series([_packed(features.found(t)) for t in texts], dtype=object), "binary")(text)

    def score_packed(self, packed: Column) -> Column:
        weights = self.weights

        def scored(rows: pd.Series) -> pd.Series:
            if weights is None:
                return pd.Series(np.zeros(len(rows)))
            row, cells = _cells(rows)
            z = np.bincount(row, _scaled(cells) * weights[cells["at"]], len(rows)) + weights[-1]
            return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return F.pandas_udf(scored, "double")(packed)

    def score(self, text: Column) -> Column:
        """Between 0 and 1; 0 where there was nothing to learn from."""
        return self.score_packed(self.packed(text))


def train(docs: DataFrame, labels: DataFrame, train_on: Column | None = None, sample_rows: int = SAMPLE_ROWS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[Classifier, DataFrame]:
    """Fit on the rows of ``docs`` where ``train_on`` holds (default: all) and
    on ``labels``, which must be of such rows. Returns the classifier and, for
    every row of ``docs``, its id, ``trains`` and packed features ``x``.

    The lexicon is counted over every labelled row, the classifier learned from at
    most ``sample_rows`` of them, chosen by a hash of the id; the label model
    counts the votes on every training document. A repeated label counts once, the higher one.
    """
    trains = F.lit(True) if train_on is None else F.coalesce(train_on, F.lit(False))
    docs = docs.select(F.col(id_col).alias("id"), trains.alias("trains"), F.col(text_col).alias("text"))
    labels = materialize(labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
                         .agg(F.max(F.col(label_col)).cast("int").alias("toxic")), "toxic-labels")
    chosen = materialize(labels.orderBy(F.xxhash64("id"), "id").limit(sample_rows), "toxic-chosen")
    bits = min(LABEL_BITS, 1 << max(10, (10 * labels.count()).bit_length()))
    may = bloom_filter(labels.select(F.col("id").alias("key")), bits)(F.col("id"))
    labelled = materialize(docs.where("trains and id is not null").where(may).join(labels.hint("merge"), "id").select("toxic", "text"), "toxic-labelled")
    lexicon = learn_keys(labelled)
    features = Features(tuple(lexicon), tuple(lexicon.values()))
    blank = Classifier(features, None)
    found = materialize(docs.select("id", "trains", blank.packed(F.col("text")).alias("x")), "toxic-features")
    if not features.names:
        return blank, found

    def vote(rows: pd.Series) -> pd.Series:
        return pd.Series(features.votes(*_cells(rows), len(rows)) @ (1 << np.arange(VOTERS)))

    pattern = found.where("trains").select("id", F.pandas_udf(vote, "long")("x").alias("pattern"))
    counted = (pattern.join(labels, "id", "left").groupBy("pattern", F.coalesce("toxic", F.lit(-1)).alias("given"))
               .agg(F.count("*").alias("n")).toPandas())    # at most 3 * 2^VOTERS rows
    bits = (counted["pattern"].to_numpy(np.int64)[:, None] >> np.arange(VOTERS) & 1).astype(bool)
    model = LabelModel(bits, counted["given"].to_numpy(), counted["n"].to_numpy())

    rows = found.where("trains").join(F.broadcast(chosen), "id").select("toxic", "x").toPandas()   # sample_rows ids at most
    row, cells = _cells(rows["x"])
    p = model.posterior(features.votes(row, cells, len(rows)), rows["toxic"].to_numpy())
    return Classifier(features, fit_linear(row, cells, len(features.names) + len(PATTERNS), p)), found
