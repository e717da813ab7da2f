"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every text is addressed by the SHA-256 of its content. The
ledger has a row for each blob and rule version that was ever scanned, with
the spans found (none included). A scan reads only pairs that the ledger
lacks, once per blob however many versions and paths share it; findings are
joined back to all of them.

Spans are found with built-in functions: ``split`` by a rule's pattern gives
the text between its matches, whose running lengths are the positions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.llm.bloom import bloom_filter
from strata.session import materialize

MAX_FILTER_BITS = 1 << 22


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``hints``: strings (lower case) of which a text with a
    match has at least one; only a shortcut, none means no shortcut.
    ``part``: the group whose length must reach ``least``."""
    kind: str
    version: int
    pattern: str
    part: int
    least: int
    hints: tuple[str, ...] = ()


# The base rules, then the published formats of three more kinds.
BASE_RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, ("private key",)),
    Rule("gitkey", 1, r"gh[pousr]_[A-Za-z0-9]+", 0, 40, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30, ("eyj",)),
)

PIECES = "array<struct<gap:int,size:int,fits:boolean>>"


def _prefilter(text: Column, rule: Rule) -> Column:
    if rule.hints:
        hint = F.lit(False)
        for h in rule.hints:
            hint = hint | F.contains(F.lower(text), F.lit(h))
        return hint
    return F.rlike(text, F.lit(rule.pattern[:-1] + "{%d,}" % rule.least))


def _pieces(text: Column, rule: Rule) -> Column:
    """Of each match, in order: the length of the text before it since the
    match before, its own length, whether it is long enough."""
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), 0), F.length)
    part = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), rule.part), lambda m: F.length(m) >= rule.least)
    zipped = F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("size"), part.alias("fits"))
    return F.when(_prefilter(text, rule), zipped.cast(PIECES)).otherwise(F.array().cast(PIECES))


def blob_id(text: Column) -> Column:
    """Content address: SHA-256 (32 bytes) of the text, null as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def scan(texts: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None = None, text_col: str = "text") -> DataFrame:
    """New ledger rows (``blob``, ``kind``, ``version``, ``spans``) for the blobs
    of ``texts`` and the rule versions that ``ledger`` lacks. Spans are (start,
    end) in characters, end exclusive. An empty table gives no rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    blobs = texts.select(blob_id(F.col(text_col)).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    every = [f"{r.kind}@{r.version}" for r in rules]
    todo = F.array(*[F.lit(r) for r in every])
    if ledger is not None:
        done = materialize(ledger.groupBy("blob").agg(F.collect_set(
            F.concat_ws("@", "kind", "version")).alias("done")), "ledger-done")
        blobs = blobs.join(done, "blob", "left")
        todo = F.array_except(todo, F.coalesce("done", F.array().cast("array<string>")))
        blobs = blobs.withColumn("todo", todo).where("size(todo) > 0")
        todo = F.col("todo")
    scans = F.array(*[
        F.when(F.array_contains(todo, name), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
                                                      _pieces(F.col("text"), r).alias("pieces")))
        for name, r in zip(every, rules)])
    rows = blobs.select("blob", F.explode(F.array_compact(scans)).alias("s")).select("blob", "s.*")
    rows = rows.select("blob", "kind", "version", F.posexplode_outer("pieces").alias("at", "piece"))
    upto = Window.partitionBy("blob", "kind", "version").orderBy("at")
    rows = rows.select("blob", "kind", "version", "piece.fits", (F.sum(F.col("piece.gap") + F.col("piece.size")).over(upto)).alias("end"),
                       F.col("piece.size").alias("size"))
    span = F.when(F.col("fits"), F.struct((F.col("end") - F.col("size")).alias("start"), F.col("end")))
    return rows.groupBy("blob", "kind", "version").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def findings(ledger: DataFrame, rules: tuple[Rule, ...], base: tuple[Rule, ...]) -> DataFrame:
    """Per blob with a span of a current rule: ``base`` and ``spans`` (arrays of
    (start, order of the kind, kind, end), by start, then kind), counts of the
    base kinds (``n_<kind>``) and ``cuts``, the merged spans."""
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    now = F.array(*[F.lit(f"{r.kind}@{r.version}") for r in rules])
    rows = (ledger.where(F.array_contains(now, F.concat_ws("@", "kind", "version")))
            .select("blob", "kind", F.explode("spans").alias("s"))
            .select("blob", "kind", "s.start", "s.end", F.try_element_at(order, F.col("kind")).alias("k")))
    earlier = Window.partitionBy("blob").orderBy("start", "k").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("seen", F.max("end").over(earlier))
    span = F.struct("start", "k", "kind", "end")
    known = [r.kind for r in base]
    return rows.groupBy("blob").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in known],
        F.sort_array(F.collect_list(F.when(F.col("kind").isin(known), span))).alias("base"),
        F.sort_array(F.collect_list(span)).alias("spans"),
        F.sort_array(F.collect_list(F.when(F.coalesce(F.col("end") > F.col("seen"), F.lit(True)), F.struct(
            F.greatest("start", F.coalesce("seen", F.lit(0))).alias("start"), F.col("end"))))).alias("cuts"))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, base: tuple[Rule, ...] = BASE_RULES,
                 ledger: DataFrame | None = None, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``docs`` (every version and path a row) with the columns of
    :func:`findings` under ``found`` (null where a text has no span; a column of
    that name is replaced, all others stay), and the ledger with the new rows."""
    new = materialize(scan(docs, rules, ledger, text_col), "ledger")
    ledger = new if ledger is None else ledger.unionByName(new)
    per_blob = findings(ledger, rules, base)
    per_blob = materialize(per_blob.select(F.col("blob").alias("_blob"), F.struct(
        *[c for c in per_blob.columns if c != "blob"]).alias("found")), "findings")
    # Most texts have no finding. A small filter of the blobs that do keeps the
    # others out of the join; where it is too full to, the join takes them all.
    bits = min(MAX_FILTER_BITS, 64 * -(-per_blob.count() * 10 // 64) or 64)
    maybe = bloom_filter(per_blob.select(F.col("_blob").alias("key")), bits)(F.col("key"))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "found"]
    rows = docs.select(F.struct(*kept).alias("row"), blob_id(F.col(text_col)).alias("key"))      # no name can clash
    hit = rows.where(maybe)
    hit = hit.join(per_blob, hit["key"] == per_blob["_blob"], "left").select("row.*", "found")
    none = F.lit(None).cast(per_blob.schema["found"].dataType).alias("found")
    return hit.unionByName(rows.where(~maybe).select("row.*", none)), ledger


def listing(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined; empty for null."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.coalesce(F.array_join(parts, ","), F.lit(""))


def redact(text: Column, cuts: Column, mark: str = "[secret]") -> Column:
    """``text`` with every span of ``cuts`` (disjoint or adjacent, in order)
    replaced by ``mark``; unchanged where ``cuts`` is null."""
    n = F.size(cuts)
    begin = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda c: c["end"]))
    end = F.concat(F.transform(cuts, lambda c: c["start"]), F.array(F.length(text).cast("long")))
    kept = F.transform(F.sequence(F.lit(1), n + 1), lambda i: F.substr(
        text, (F.element_at(begin, i) + 1).cast("int"), (F.element_at(end, i) - F.element_at(begin, i)).cast("int")))
    return F.when(cuts.isNull(), text).otherwise(F.array_join(kept, mark))
