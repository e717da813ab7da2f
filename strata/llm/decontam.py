"""Benchmark decontamination by canonical templates.

Texts become sequences of template tokens: words in lower case, with numbers,
names (capitalised within a sentence) and units (after a number) replaced by
typed placeholders whose values are kept as slots. Operators between operands
are tokens, and so is each character of a script without spaces. Windows of template tokens
are hash-joined with those of the benchmark. So a question is found with other numbers, names or units too, but
not where they contradict each other along an alignment of a document and an
item: each value of the item must stand for one of the document, and for names
and units the other way round, too.

Documents send on only windows whose hash passes a fixed-size bitmap of the
benchmark's window hashes; the join then compares whole templates.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from strata.session import materialize

# Scripts without spaces between words (Chinese, Japanese, Thai, Lao, Burmese, Khmer): each character is a token.
UNSPACED = ("\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ecd\u1000-\u103f\u1050-\u108f\u1780-\u17d3\u3041-\u30ff"
            "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003134f")
LETTER = rf"[^\W\d_{UNSPACED}]"
# Signs of calculation, where they stand between operands: not hyphens, bullets or slashes of prose.
OPERATORS = "+=^×÷*/<>-−"
# The definition of a token; Templates finds the same tokens by array passes, and the tests compare the two.
TOKEN = re.compile(rf"{LETTER}+(?:['’]{LETTER}+)*|\d+(?:[.,]\d+)*|[.!?:;。！？]|\n|[{UNSPACED}]"
                   r"|[+=^×÷](?:(?<=[\w)].)|(?<=[\w)] .))(?= ?[\w(?])|[*/<>−-](?:(?<=[\d)].)|(?<=[\d)] .))(?= ?[\d(])")
# Words that are units after a number.
UNITS = frozenset("""
mm cm m km inch inches foot feet ft yard yards mile miles mi mg g kg lb lbs oz ounce ounces pound pounds gram grams
kilogram kilograms ton tons tonne tonnes ml l liter liters litre litres gallon gallons ms s sec secs second seconds min
mins minute minutes h hr hrs hour hours day days week weeks month months year years cent cents dollar dollars euro euros
percent degree degrees mph kmh kph watt watts kw volt volts amp amps hz khz mhz ghz byte bytes kb mb gb tb
""".split())
LITERAL, NUMBER, UNIT, NAME, END, OPERATOR, CHARACTER = range(7)
PLACEHOLDER = {NUMBER: "<num>", NAME: "<name>", UNIT: "<unit>"}
ALONE = re.compile(f"[{UNSPACED}]")
BITMAP_BITS = 1 << 22
BATCH_CHARS = 1 << 18    # texts laid end to end at once, unless one is longer
BASE, SPREAD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93      # odd: a word's polynomial, mixing
# What a character can be within a token (bits); IN_WORD and IN_NUMBER alone make runs.
IN_WORD, IN_NUMBER, STOP, UNSPACED_ONE, SIGN, JOINT, LOWER, UPPER = (1 << i for i in range(8))
BETWEEN_WORDS, BETWEEN_NUMBERS, STOPS, WIDE = "'’", ".,", ".!?:;。！？\n", "+=^×÷"


def _mix(x: np.ndarray, by: int) -> np.ndarray:
    x = x * np.uint64(by)
    return x ^ (x >> np.uint64(32))


class Templates:
    """Template tokens of texts laid end to end in one array of characters: those
    that ``TOKEN`` finds, by a few passes over the array. Every distinct character
    is classified once; a word's hash is a polynomial of its characters in lower case."""

    def __init__(self):
        self.known = np.zeros(0x110000, bool)
        self.bits = np.zeros(0x110000, np.uint8)
        self.first = np.zeros(0x110000, np.int8)        # kind of a token that begins with the character
        self.value = np.zeros(0x110000, np.uint64)
        self.powers = self.inverse = np.ones(0, np.uint64)
        self.mark = {k: np.uint64(xxhash.xxh64_intdigest(mark)) for k, mark in PLACEHOLDER.items()}
        self.longest_unit = max(map(len, UNITS))
        self.units = np.sort(self._hashes(self._laid(list(UNITS))[0], *self._spans(list(UNITS))))

    @staticmethod
    def _spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each text where they are laid end to end."""
        size = np.array([len(t) for t in texts], np.int64)
        end = np.cumsum(size + 1)
        return end - size, end

    def _laid(self, texts: list[str]) -> tuple[np.ndarray, str]:
        """The characters of texts, with a NUL before each and two after the last; also as a string."""
        joined = "\0" + "\0".join(texts) + "\0\0"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        if not (known := self.known[codes]).all():
            for c in np.unique(codes[~known]).tolist():
                self._classify(c)
        return codes, joined

    def _classify(self, code: int) -> None:
        c = chr(code)
        word = c.isalnum() and not c.isdecimal() and not ALONE.match(c)
        self.bits[code] = (IN_WORD * word | IN_NUMBER * c.isdecimal() | STOP * (c in STOPS) | UNSPACED_ONE * bool(ALONE.match(c))
                           | SIGN * (c in OPERATORS) | JOINT * (c in BETWEEN_WORDS + BETWEEN_NUMBERS)
                           | LOWER * c.islower() | UPPER * (c.isupper() or c.istitle()))
        self.first[code] = (NUMBER if c.isdigit() else OPERATOR if c in OPERATORS else CHARACTER if ALONE.match(c)
                            else END if not c.isalpha() else NAME if c.isupper() else LITERAL)
        # In lower case a last sigma has its own form; the only character that becomes two (U+0130) stays itself.
        low = "σ" if c in "Σς" else c.lower()
        self.value[code] = _mix(np.array([ord(low) if len(low) == 1 else code], np.uint64) + np.uint64(1), SPREAD)[0]
        self.known[code] = True

    def _hashes(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of each span's characters in lower case, wherever it stands."""
        if len(self.powers) < len(codes):
            n = len(codes) + BATCH_CHARS
            self.powers, self.inverse = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]))
                                         for b in (BASE, pow(BASE, -1, 1 << 64)))
        upto = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(self.value[codes] * self.powers[:len(codes)], out=upto[1:])
        return _mix((upto[end] - upto[start]) * self.inverse[start], SPREAD)

    def _tokens(self, codes: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each token."""
        run = bits & np.uint8(IN_WORD | IN_NUMBER)
        one = (bits & np.uint8(STOP | UNSPACED_ONE)) != 0
        here = lambda at, chars: np.isin(codes[at], [ord(c) for c in chars])
        at = np.flatnonzero(bits & np.uint8(JOINT))             # within a word or number
        at = at[(run[at - 1] == run[at + 1]) & (run[at - 1] == np.where(here(at, BETWEEN_WORDS), IN_WORD, IN_NUMBER))]
        run[at], one[at] = bits[at - 1] & np.uint8(IN_WORD | IN_NUMBER), False
        at = np.flatnonzero(bits & np.uint8(SIGN))              # between operands
        wide = here(at, WIDE)

        def operand(i: np.ndarray, bracket: str, mark: str) -> np.ndarray:
            digit = (bits[i] & np.uint8(IN_NUMBER)) != 0
            word = digit | ((bits[i] & np.uint8(IN_WORD)) != 0) | here(i, "_" + mark)
            alone = (bits[i] & np.uint8(UNSPACED_ONE)) != 0
            word[alone] |= np.array([chr(c).isalnum() for c in codes[i[alone]].tolist()], bool)
            return np.where(wide, word, digit) | here(i, bracket)

        before = operand(at - 1, ")", "") | here(at - 1, " ") & operand(np.maximum(at - 2, 0), ")", "")
        after = operand(at + 1, "(", "?") | here(at + 1, " ") & operand(at + 2, "(", "?")
        one[at[before & after]] = True
        change = run[1:] != run[:-1]
        return (np.flatnonzero(change & (run[1:] != 0) | one[1:]) + 1,
                np.flatnonzero(change & (run[:-1] != 0) | one[:-1]) + 1)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, "Words", np.ndarray]:
        """Template tokens of several texts laid end to end: kinds, hashes, hashes
        of their words, their words, and the text each belongs to."""
        codes, joined = self._laid(texts)
        bits = self.bits[codes]
        start, end = self._tokens(codes, bits)
        text = np.searchsorted(self._spans(texts)[1], start, "right")
        kind, exact = self.first[codes[start]], self._hashes(codes, start, end)
        # A name has small letters after its capital, and no other capital.
        capital = np.flatnonzero(kind == NAME)
        after = np.stack([start[capital] + 1, end[capital]], 1)
        rest = np.bitwise_or.reduceat(bits, after.ravel())[::2] if len(after) else np.zeros(0, np.uint8)
        kind[capital[(after[:, 0] == after[:, 1]) | (rest & np.uint8(LOWER | UPPER) != LOWER)]] = LITERAL
        fresh = np.ones(len(kind), bool)                # first of its text
        fresh[1:] = text[1:] != text[:-1]
        first = fresh.copy()                            # of a sentence
        first[1:] |= kind[:-1] == END
        real = kind != END
        kind, text, first, exact = kind[real], text[real], first[real], exact[real]
        words = Words(joined, start[real], end[real])
        after_number = np.zeros(len(kind), bool)
        after_number[1:] = (kind[:-1] == NUMBER) & (text[1:] == text[:-1])
        kind[(kind == NAME) & first] = LITERAL
        # A unit is one after a number only, and never a name.
        maybe = np.flatnonzero(((kind == NAME) | (kind == LITERAL) & after_number) & (words.end - words.start <= self.longest_unit))
        maybe = maybe[self.units[np.minimum(np.searchsorted(self.units, exact[maybe]), len(self.units) - 1)] == exact[maybe]]
        unit = maybe[np.array([words[i] in UNITS for i in maybe.tolist()], bool)]
        kind[unit] = np.where(after_number[unit], UNIT, LITERAL)
        code = exact.copy()
        for k, mark in self.mark.items():
            code[kind == k] = mark
        return kind, code, exact, words, text


class Words:
    """The words of template tokens, in lower case."""

    def __init__(self, joined: str, start: np.ndarray, end: np.ndarray):
        self.joined, self.start, self.end = joined, start, end

    def __getitem__(self, i: int) -> str:
        return self.joined[self.start[i]:self.end[i]].lower()


def _window_hashes(code: np.ndarray, sizes: list[int]) -> Iterator[np.ndarray]:
    """Hashes of the windows of each size, ascending: a longer one goes on from a shorter."""
    h, done = np.zeros(len(code), np.uint64), 0
    for size in sizes:
        for i in range(done, size):
            h = h[:max(len(code) - i, 0)] ^ code[i:]
            h *= np.uint64(BASE)
            h ^= h >> np.uint64(29)
        done = size
        yield h


def _windows(sizes: list[int] | None, window: int, least: int, literals: int, bitmap: np.ndarray | None):
    """Pandas function: rows (id, text) to windows (id, at, size, hash, template, slots).

    A window comes as its template if it holds enough plain words, and word for
    word, without slots, if it holds placeholders or too few plain words.

    With ``sizes`` None a text gives windows of ``window`` tokens, or is one
    window if it is shorter (``least`` tokens or more). Where a window holds
    characters of unspaced scripts, two of them stand for a word and it has
    twice as many tokens."""
    columns = ["id", "at", "size", "hash", "template", "slots"]

    def found(templates: Templates, keys: list, texts: list[str]) -> list[tuple]:
        kind, code, exact, words, text = templates.of(texts)
        count = np.bincount(text, minlength=len(texts))
        begin = np.cumsum(count) - count
        sums = lambda a: np.concatenate([[0], np.cumsum(a)])
        plain, chars = sums(2 * (kind == LITERAL) + (kind == CHARACTER)), sums(kind == CHARACTER)
        slots = sums((kind == NUMBER) | (kind == UNIT) | (kind == NAME))
        out = []
        every = sizes if sizes is not None else range(least, 2 * window + 1)
        for size, *hashes in zip(every, _window_hashes(code, every), _window_hashes(exact, every)):
            if len(kind) < size:
                break
            inside = text[size - 1:] == text[:len(kind) - size + 1]
            enough = plain[size:] - plain[:-size] >= 2 * literals
            if bitmap is None:
                n_chars = chars[size:] - chars[:-size]
                short = (count[text[:len(inside)]] == size) & (2 * size - n_chars >= 2 * least)     # a whole short text
                inside &= np.where(n_chars > 0, (size == 2 * window) | short, (size == window) | short & (size < window))
            for typed, h, hit in ((True, hashes[0], inside & enough), (False, hashes[1], inside & (~enough | (slots[size:] > slots[:-size])))):
                if bitmap is not None:
                    low = (h & np.uint64(BITMAP_BITS - 1)).astype(np.int64)
                    hit = hit & (bitmap[low >> 3] >> (low & 7).astype(np.uint8) & 1).astype(bool)
                for i in np.flatnonzero(hit).tolist():
                    k, own = kind[i:i + size].tolist(), [words[x] for x in range(i, i + size)]
                    mark = PLACEHOLDER if typed else {}
                    out.append((keys[text[i]], i - int(begin[text[i]]), size, int(h[i:i + 1].view(np.int64)[0]),
                                " ".join(mark.get(t, x) for t, x in zip(k, own)),
                                [f"{p}:{mark[t]}:{x}" for p, (t, x) in enumerate(zip(k, own)) if t in mark]))
        return out

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        templates = Templates()
        for batch in batches:
            keys, texts = batch["id"].tolist(), [t or "" for t in batch["text"]]
            part = np.cumsum([len(t) for t in texts]) // BATCH_CHARS
            for p in np.unique(part):
                at = np.flatnonzero(part == p)
                out = found(templates, [keys[i] for i in at], [texts[i] for i in at])
                if out:
                    yield pd.DataFrame(out, columns=columns)
    return windows


def _bitmap(windows: DataFrame) -> np.ndarray:
    """The bits of all window hashes: at most BITMAP_BITS / 64 rows reach the driver."""
    at = F.pmod(F.col("hash"), F.lit(BITMAP_BITS).cast("long"))
    rows = (windows.select(at.alias("at")).groupBy(F.expr("at div 64").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("v")).collect())
    words = np.zeros(BITMAP_BITS // 64, "<i8")
    words[[r["word"] for r in rows]] = [r["v"] for r in rows]
    return words.view(np.uint8)


def _judge(by_window: bool):
    """Function of an alignment's windows to the places of those that count, how
    many of these have the item's own values, the longest run of consecutive ones,
    and whether all slots have the item's value."""

    def judged(windows):
        slots = {tuple(s) for w in windows for s in w["slots"]}     # place, kind, mine, theirs
        same = all(mine == theirs for _, _, mine, theirs in slots)
        votes = Counter((kind, mine, theirs) for _, kind, mine, theirs in slots)
        there, back = {}, {}
        for kind, mine, theirs in sorted(votes, key=lambda v: (-votes[v], v[1] != v[2], v)):
            there.setdefault((kind, mine), theirs)
            back.setdefault((kind, theirs), mine)

        def agrees(s) -> bool:
            return there[s["kind"], s["mine"]] == s["theirs"] and (
                s["kind"] == PLACEHOLDER[NUMBER] or back[s["kind"], s["theirs"]] == s["mine"])

        places = [(w["item_at"], w["size"]) for w in windows if all(map(agrees, w["slots"]))
                  or by_window and all(s["mine"] == s["theirs"] for s in w["slots"])]
        if not by_window and len(places) < len(windows):
            return [], 0, 0, same
        own = {w["item_at"] for w in windows if all(s["mine"] == s["theirs"] for s in w["slots"])}
        places = sorted(set(places))
        run = longest = 0
        before = None
        for at in sorted({at for at, _ in places}):
            run = run + 1 if before == at - 1 else 1
            before, longest = at, max(longest, run)
        return places, len(own), longest, same
    return judged


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 8, least: int = 5,
                  literals: int = 4, min_windows: int = 1, by_window: bool = False) -> DataFrame:
    """One row per document and benchmark item found in it: the two ids,
    ``n_windows`` (matching windows), ``share`` (of the item's distinct
    windows) and ``same_values`` (whether every slot of an alignment has the
    item's value), ``n_own`` (most windows of an alignment with the item's own
    values) and ``run`` (most consecutive windows).

    An alignment whose slots contradict each other counts for nothing as a
    whole; with ``by_window``, which the queries use, all its windows with the
    item's own values count, and of the others those that agree with the value
    most places have.

    Windows with fewer than ``literals`` plain words match only word for word,
    the others also with other values. Items shorter than ``window`` are one
    window; those under ``least`` tokens, and null texts, are not searched. Two
    characters of an unspaced script stand for a word in all three. Documents with a null id are reported under null.
    Repeated rows count once. Without benchmark items no row comes back.
    """
    schema = lambda of: T.StructType([T.StructField("id", of), T.StructField("at", T.LongType()), T.StructField("size", T.LongType()),
                                      T.StructField("hash", T.LongType()), T.StructField("template", T.StringType()),
                                      T.StructField("slots", T.ArrayType(T.StringType()))])
    items = materialize(
        benchmark.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("text"))
        .mapInPandas(_windows(None, window, least, literals, None), schema(benchmark.schema[item_col].dataType)), "benchmark-windows")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())    # least .. 2 * window
    found = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .mapInPandas(_windows(sizes, window, least, literals, _bitmap(items)), schema(docs.schema[id_col].dataType)))
    item = items.select(F.col("id").alias("item"), F.col("at").alias("item_at"), "size", "hash", "template",
                        F.col("slots").alias("item_slots"))
    value = lambda s, i: F.element_at(F.split(s, ":", 3), i)
    pairs = found.join(item, ["hash", "size", "template"]).select(
        "id", "item", "item_at", "size", (F.col("at") - F.col("item_at")).alias("shift"),
        # of each slot: place in the item, kind, the item's value, the document's
        F.zip_with("item_slots", "slots", lambda a, b: F.struct(
            (F.col("item_at") + value(a, 1).cast("long")).alias("place"), value(a, 2).alias("kind"),
            value(a, 3).alias("mine"), value(b, 3).alias("theirs"))).alias("slots"))
    aligned = pairs.groupBy("id", "item", "shift").agg(F.collect_set(F.struct("item_at", "size", "slots")).alias("windows"))
    judged = F.udf(_judge(by_window), "places array<struct<item_at:long,size:long>>, own long, run long, same_values boolean")
    aligned = aligned.select("id", "item", judged("windows").alias("found")).select("id", "item", "found.*")
    totals = item.groupBy("item").agg(F.countDistinct("item_at", "size").alias("total"))
    hits = aligned.where(F.size("places") > 0).groupBy("id", "item").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("n_windows"),
        F.max("same_values").alias("same_values"), F.max("own").alias("n_own"), F.max("run").alias("run"))
    hits = hits.where(F.col("n_windows") >= min_windows).join(totals, "item")
    return hits.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "n_windows",
                       (F.col("n_windows") / F.col("total")).alias("share"), "same_values", "n_own", "run")
