"""Incremental secret scan over content-addressed blobs.

Every version of a document is a path to a blob, named by the SHA-256 of its text. The ledger, a
table of parquet files, holds for each scanned blob the rules (name and version) it was scanned
with and what they found. A scan looks up which (blob, rule version) pairs are not in the ledger, takes
one text of each such blob, applies just the missing rules, appends the findings, and joins the
ledger back to all paths. Scanning again, or with one changed rule, reads texts only for the new pairs.

Positions come from the text between matches: a match starts behind the summed lengths of the
gaps and matches before it, a running sum over the matches of one text.

Everything is built-in functions. Hot groups of copies meet the ledger in a join that Spark can split.

Edge cases: a NULL text is an empty one; NULL and repeated doc ids are paths like any other; an empty
table gives no rows and leaves the ledger as it is; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlog.llm.common import whole_text
from starlog.operators.joins import join_null_safe
from starlog.session import file_system, materialise

FINDING = "start long, kind long, end long, rule string"
LEDGER = f"blob binary, rules array<string>, findings array<struct<{FINDING}>>"


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches are secrets if the captured group has at least `min_length` characters."""

    name: str
    pattern: str
    group: int = 0
    min_length: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# A private key with all its lines: through the END line, if no other line of five dashes stands before it; else the
# headers and base64 lines that follow, also where line feeds are written as \n. Java's engine holds some frames for
# each round of a group, so these are counted: 250 dashes before END, 200 indented lines; other lines need no rounds.
PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:"
    r"[^-]*(?:-{1,4}[^-]+){0,250}-----END [A-Z ]*PRIVATE KEY-----"
    r"|\x20*[A-Za-z0-9+/=\\]{40,}"
    r"|(?:[\x20\t\r]*\n[\x20\t]*[A-Za-z-]+:\x20[^\n]*){0,9}"
    r"(?:\s*\n[\x20\t]*[A-Za-z0-9+/=\r\n]*[A-Za-z0-9+/=][\x20\t]*\r?(?m:$)){0,200})"
)

#: Order matters: spans that start together are listed in it.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        min_length=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", min_length=20),
    # runs of 24 and more: a run is matched whole, so shorter ones need not be found first
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", PRIVATE_KEY, version=2),
    Rule("hub_token", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
BASE = ("assign", "access", "hex")


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, one row per blob and scan; empty if there is none yet."""
    system, location = file_system(spark, path)
    if not system.exists(location):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def find(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, findings) of the texts in which one of the row's `rules` matches.

    `blobs` has blob, text and rules (keys of the rules to apply).
    """
    applied = [
        F.when(
            F.array_contains("rules", rule.key) & F.col("text").rlike(rule.pattern),
            F.struct(
                F.lit(kind).cast("long").alias("kind"),
                F.lit(rule.key).alias("rule"),
                F.arrays_zip(
                    F.transform(F.split("text", rule.pattern, -1), lambda gap: F.length(gap)).alias("gap"),
                    F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0)).alias("match"),
                ).alias("found"),
            ),
        )
        for kind, rule in enumerate(rules)
    ]
    by_rule = blobs.select("blob", F.explode(F.array(*applied)).alias("hit")).where("hit IS NOT NULL")
    # rows repeated under one doc id hold the same blob twice
    by_rule = by_rule.select("blob", "hit.*").dropDuplicates(["blob", "kind"])
    found = by_rule.select("blob", "kind", "rule", F.posexplode("found").alias("at", "one"))
    found = found.select("blob", "kind", "rule", "at", "one.gap", "one.match").where("match IS NOT NULL")
    size = F.length("match").cast("long")
    before = Window.partitionBy("blob", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = found.withColumn("end", F.sum(F.col("gap") + size).over(before)).withColumn("start", F.col("end") - size)
    long_enough = F.lit(False)
    for rule in rules:
        captured = F.col("match") if not rule.group else F.regexp_extract("match", rule.pattern, rule.group)
        long_enough = long_enough | ((F.col("rule") == rule.key) & (F.length(captured) >= rule.min_length))
    finding = F.struct("start", "kind", "end", "rule")
    return placed.where(long_enough).groupBy("blob").agg(F.collect_list(finding).alias("findings"))


def scan_unseen(docs: DataFrame, paths: DataFrame, ledger: str, rules: tuple[Rule, ...]) -> None:
    """Scan the (blob, rule version) pairs that the ledger lacks and append them."""
    keys = F.array(*[F.lit(rule.key) for rule in rules])
    seen = read_ledger(docs.sparkSession, ledger).groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
    # one path of each blob stands for it
    blobs = paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    missing = F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))
    unseen = blobs.join(seen, "blob", "left").select("blob", "doc_id", missing.alias("rules")).where(F.size("rules") > 0)
    unseen = materialise(unseen)
    if unseen.isEmpty():
        return
    text = whole_text("text")
    versions = docs.select("doc_id", blob_id(text).alias("blob"), text.alias("text"))
    chosen = join_null_safe(versions, unseen, ["blob", "doc_id"], "inner")
    hits = materialise(find(chosen, rules))
    none = F.array().cast(f"array<struct<{FINDING}>>")
    unseen.join(hits, "blob", "left").select(
        "blob", "rules", F.coalesce("findings", none).alias("findings")
    ).write.mode("append").parquet(ledger)


def scan(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, findings) for every row of `docs` (doc_id, text); findings in order of place.

    A finding is (start, kind, end, rule): code points of the text, end exclusive; kind is the rule's
    place in `rules`. `ledger` is a folder that all executors can reach.
    """
    paths = materialise(docs.select("doc_id", blob_id(whole_text("text")).alias("blob")))
    scan_unseen(docs, paths, ledger, rules)
    current = [rule.key for rule in rules]
    by_blob = read_ledger(docs.sparkSession, ledger).groupBy("blob").agg(
        F.flatten(F.collect_list("findings")).alias("findings")
    )
    wanted = F.filter("findings", lambda finding: finding["rule"].isin(current))
    found = by_blob.select("blob", F.sort_array(F.array_distinct(wanted)).alias("findings"))
    # stored, so that the join shuffles both sides for itself and can split a hot blob
    found = materialise(found.where(F.size("findings") > 0))
    none = F.array().cast(f"array<struct<{FINDING}>>")
    joined = paths.join(found, "blob", "left")
    return joined.select("doc_id", "blob", F.coalesce("findings", none).alias("findings"))


def as_text(findings: Column, names: Column) -> Column:
    """Findings as name:start:end, comma-joined."""
    named = F.transform(findings, lambda x: F.concat_ws(":", F.get(names, x["kind"].cast("int")), x["start"], x["end"]))
    return F.array_join(named, ",")


def redact(text: Column, findings: Column, mark: str = "[secret]") -> Column:
    """The text with the found spans replaced; spans that overlap or touch become one mark."""

    def step(done: Column, span: Column) -> Column:
        apart = (span["start"] > done["at"]) | (F.size(done["parts"]) == 0)
        gap = F.substring(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        return F.struct(
            F.when(apart, F.concat(done["parts"], F.array(gap))).otherwise(done["parts"]).alias("parts"),
            F.greatest(done["at"], span["end"]).alias("at"),
        )

    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("long").alias("at"))

    def close(done: Column) -> Column:
        rest = F.substring(text, (done["at"] + 1).cast("int"), F.length(text))
        return F.array_join(F.concat(done["parts"], F.array(rest)), mark)

    return F.when(F.size(findings) == 0, text).otherwise(F.aggregate(findings, start, step, close))


def redact_found(docs: DataFrame, found: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The rows of `docs` with the secrets that `scan` found in them replaced in `text`.

    Rows meet their findings by the blob, so repeated rows and NULL doc ids do too; NULL texts stay.
    """
    by_blob = found.where(F.size("findings") > 0).select("blob", "findings").dropDuplicates(["blob"])
    by_blob = materialise(by_blob.withColumnsRenamed({"blob": "__blob", "findings": "__findings"}))
    joined = docs.join(by_blob, blob_id(whole_text(docs["text"])) == F.col("__blob"), "left")
    clean = F.when(F.col("__findings").isNull(), F.col("text")).otherwise(redact(F.col("text"), F.col("__findings"), mark))
    return joined.select(*[docs[c] for c in docs.columns if c != "text"], clean.alias("text"))
