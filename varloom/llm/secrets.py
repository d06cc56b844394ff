"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every text version is addressed by the SHA-256 of its content.  The ledger holds, for each (blob, rule, version)
that was ever scanned, the spans found.  A run scans each blob once for the rules whose current version the
ledger lacks, adds the new rows, and joins the findings back to every path (document) that holds the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import empty_for_null

SPAN = "struct<start:int,rank:int,kind:string,stop:int>"
LEDGER = "blob string, rule string, version int, spans array<struct<start:int,rank:int,kind:string,stop:int>>"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of a pattern; `group` must have `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


# The base rules, in their listed order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),  # runs of [0-9a-f]+ with 32 or more characters
)
# A key block: header fields, then all up to the END line, or without one the lines of base64.  Quantifiers over
# groups are possessive, as others recurse for each line.
_GAP = r"""(?:\\[nr]|[\x20\t\r\n"'>|])*+"""
_FIELDS = rf"(?:{_GAP}[A-Z][A-Za-z]{{1,30}}-[A-Za-z]{{1,30}}:[^\r\n\\]{{0,200}})*+"
_LAST = rf"(?:{_GAP}[A-Za-z0-9+/]{{1,15}}(?:={{1,2}}|(?=[\r\n\\\"'])|(?![\s\S])))?+"
_BASE64 = rf"(?:{_GAP}[A-Za-z0-9+/]{{16,}}={{0,2}})++{_LAST}"
_KEY = rf"-----BEGIN [A-Z ]{{0,40}}PRIVATE KEY-----{_FIELDS}(?:[^-]*+-----END [A-Z ]{{0,40}}PRIVATE KEY-----|{_BASE64})?+"
# Rules that the scan adds to the base ones.
ADDED = (
    Rule("private_key", _KEY, 0, 1, version=2),
    Rule("forge_token", r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("web_token", r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 32),
)
RULES = BASE + ADDED


def _running_starts(gaps: Column, sizes: Column) -> Column:
    """Start of each match, from the lengths of the text pieces around the matches and of the matches."""
    step = F.zip_with(F.slice(gaps, 1, F.size(sizes)), sizes, lambda g, s: F.struct(g.alias("g"), s.alias("s")))
    empty = F.array().cast("array<struct<start:int,stop:int>>")
    first = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["g"]
        stop = start + x["s"]
        return F.struct(stop.alias("at"), F.array_append(state["spans"], F.struct(start.alias("start"), stop.alias("stop"))).alias("spans"))

    return F.aggregate(step, first, add, lambda state: state["spans"])


def _entry(i: int, rule: Rule) -> Column:
    """The ledger entry of a rule for the matched strings in hit{i}; null where the rule is not to run."""
    hit = F.col(f"hit{i}")
    sizes = F.transform(hit, lambda m: F.length(m))
    kept = sizes
    if rule.group:
        kept = F.transform(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)), lambda m: F.length(m))
    gaps = F.transform(F.split("text", rule.pattern, -1), lambda g: F.length(g))
    spans = F.zip_with(_running_starts(gaps, sizes), kept, lambda s, n: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), n.alias("n")))
    spans = F.transform(
        F.filter(spans, lambda x: x["n"] >= rule.least),
        lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("rank"), F.lit(rule.kind).alias("kind"), x["stop"].alias("stop")),
    )
    spans = F.when(F.size(hit) > 0, spans).otherwise(F.array().cast(f"array<{SPAN}>"))
    return F.when(hit.isNotNull(), F.struct(F.lit(rule.kind).alias("rule"), F.lit(rule.version).alias("version"), spans.alias("spans")))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, and for each rule of its column `todo` a row (rule, version, spans) with code-point spans.

    Regular expressions run once over a text for each rule; only texts with a match are cut into pieces.
    """
    found = blobs
    for i, rule in enumerate(rules):
        hits = F.when(F.array_contains("todo", rule.kind), F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0)))
        found = found.withColumn(f"hit{i}", hits)
    parts = [_entry(i, rule) for i, rule in enumerate(rules)]
    rows = found.select("blob", F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("x"))
    return rows.select("blob", "x.rule", "x.version", "x.spans")


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def unseen(versions: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, text, todo: each distinct content once, with the rules that the ledger has not yet run on it."""
    every = F.array(*(F.lit(r.kind) for r in rules))
    blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        return blobs.withColumn("todo", every)
    current = F.create_map(*(x for r in rules for x in (F.lit(r.kind), F.lit(r.version))))
    seen = ledger.filter(current[F.col("rule")] == F.col("version")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    todo = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "text", todo.alias("todo")).filter(F.size("todo") > 0)


def with_blob(docs: DataFrame, text: str = "text") -> DataFrame:
    body = empty_for_null(text)
    return docs.withColumn("blob", F.sha2(body.cast("binary"), 256)).withColumn("text", body)


def update_ledger(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows that this run adds to the ledger (write them beside the old ones)."""
    versions = with_blob(docs.select(F.col(text).alias("text"))).select("blob", "text")
    return scan(unseen(versions, ledger, rules), rules)


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, spans of the current rules, by start and then in the rules' order; only blobs with a span."""
    current = F.create_map(*(x for r in rules for x in (F.lit(r.kind), F.lit(r.version))))
    rows = ledger.filter((current[F.col("rule")] == F.col("version")) & (F.size("spans") > 0)).dropDuplicates(["blob", "rule"])
    return rows.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def scan_paths(
    docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text", spans: str = "spans"
) -> DataFrame:
    """Every row of docs with a column `spans`, the findings of its content (an empty array without any).

    Null texts count as empty.  Null and repeated keys keep their rows, repeated contents are scanned once, an
    empty table gives an empty result.  A column of docs that has the name given for `spans` is replaced.
    """
    new = update_ledger(docs, ledger, rules, text)
    known = new if ledger is None else ledger.select("blob", "rule", "version", "spans").unionByName(new)
    return at_paths(docs, known, rules, text, spans)


def at_paths(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", spans: str = "spans") -> DataFrame:
    """Every row of docs with what a ledger knows of its content; nothing is scanned."""
    found = findings(ledger, rules).select(F.col("blob").alias("__blob"), F.col("spans").alias("__found"))
    keyed = docs.drop(spans).withColumn("__blob", F.sha2(empty_for_null(text).cast("binary"), 256))
    out = keyed.join(found, "__blob", "left").withColumn(spans, F.coalesce("__found", F.array().cast(f"array<{SPAN}>")))
    return out.drop("__blob", "__found")


def scan_with_folder(docs: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, text: str = "text", spans: str = "spans") -> DataFrame:
    """scan_paths with a ledger that lives in a Parquet folder, which a first run starts.

    Only contents and rule versions that the folder lacks are scanned; their rows are appended, also those without
    findings, and stay for later runs.  Runs that overlap may add a row twice, which counts once.
    """
    spark = docs.sparkSession
    try:
        old = spark.read.parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        old = empty_ledger(spark)
    update_ledger(docs, old, rules, text).write.mode("append").parquet(folder)
    return at_paths(docs, spark.read.parquet(folder), rules, text, spans)


def span_text(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, counts and the hash of the base spans, and all spans, read from the operator's spans."""
    base = [r.kind for r in BASE]
    own = F.filter("spans", lambda s: s["kind"].isin(*base))
    return scanned.select(
        "doc_id",
        *(count_of(F.col("spans"), k).alias(f"n_{k}") for k in base),
        F.sha2(span_text(own).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch covered by spans replaced by a mark."""
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(state: Column, s: Column) -> Column:
        ahead = s["start"] >= state["at"]
        out = F.when(ahead, F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mark)))
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), out.otherwise(state["out"]).alias("out"))

    rest = F.aggregate(spans, first, cut, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)
