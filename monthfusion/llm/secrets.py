r"""Secret scans with an incremental blob ledger (native).

A path may have many versions and many paths may hold the same text.  Every text is
addressed by its SHA-256 (a blob).  The ledger, two Parquet tables that only grow,
records which (blob, rule, version) pairs were scanned and what was found.  A run

1. takes one text per blob (copies are combined before the shuffle),
2. removes the pairs that the ledger has, so a new rule, or a new version of one,
   scans old blobs for that rule only, and a known blob costs an anti-join,
3. scans the rest, appends findings, then the scanned pairs; a run that is lost
   in between leaves pairs unscanned in the ledger, and its findings are written again,
4. joins findings, one row per blob, back to all paths.

Places of matches: the pieces between the matches and the matches themselves, in order,
have lengths whose running sum, over the matches of one text, gives every start.
Starts count code points and ends are exclusive.

Defined cases: NULL text is the empty blob.  Repeated rows give repeated results, and
so do NULL and tied ids, since paths are never grouped.  Empty tables give empty
results.  Other columns are not read,
whatever their names.  A very long text is scanned whole, as one blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthfusion.llm.sqltext import let
from monthfusion.sources.scratch import scratch_dir


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` for which ``holds`` (SQL on ``m``) is true."""

    kind: str
    version: int
    pattern: str
    holds: str = "true"
    base: bool = False


_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["\x27]?\x20*[:=]\x20*["\x27]?([A-Za-z0-9+/_.=-]+)"""

#: The order of rules is the order of kinds within one start.
RULES = (
    Rule("assign", 1, _ASSIGN, f"length(regexp_extract(m, r'{_ASSIGN}', 2)) >= 6", base=True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", "length(m) >= 20", base=True),
    Rule("hex", 1, r"[0-9a-f]{24,}", base=True),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", 1, r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]*"),
    Rule("host_token", 1, r"\b(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|glpat-[A-Za-z0-9_-]{20})"),
    Rule("url_password", 1, r"\b[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/@]{3,}@"),
)


def matches(rule: Rule, order: int) -> str:
    """Array of (order, gap before, length, holds) for a text ``text``, in order."""
    regex = f"r'{rule.pattern}'"
    each = f"transform(a, (m, i) -> named_struct('rule', {order}, 'n', i, 'gap', cast(length(p[i]) AS bigint), 'len', cast(length(m) AS bigint), 'holds', {rule.holds}))"
    found = let("a", f"regexp_extract_all(text, {regex}, 0)", let("p", f"split(text, {regex}, -1)", each))
    return f"if(array_contains(todo, {order}) AND text RLIKE {regex}, {found}, array())"


class Ledger:
    """What was scanned, and what was found, under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _read(self, name: str, ddl: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        return self.spark.read.schema(ddl).parquet(path) if self._exists(path) else self.spark.createDataFrame([], ddl)

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob binary, kind string, version int")

    def findings(self) -> DataFrame:
        found = self._read("findings", "blob binary, kind string, version int, start long, end long")
        return found.distinct()

    def scan(self, texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan what is new in ``texts`` (column ``text``) for ``rules``."""
        blobs = texts.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", F.expr("unhex(sha2(text, 256))"))
        blobs = blobs.groupBy("blob").agg(F.any_value("text").alias("text"))
        table = ", ".join(f"named_struct('kind', '{r.kind}', 'version', {r.version}, 'rule', {k})" for k, r in enumerate(rules))
        if self._exists(f"{self.folder}/scanned"):
            pairs = blobs.select("blob", F.expr(f"inline(array({table}))"))
            unseen = pairs.join(self.scanned(), ["blob", "kind", "version"], "left_anti").groupBy("blob").agg(F.collect_list("rule").alias("todo"))
            blobs = blobs.join(unseen, "blob")
        else:
            blobs = blobs.withColumn("todo", F.expr(f"array({', '.join(str(k) for k in range(len(rules)))})"))
        found = blobs.select("blob", "todo", F.expr(f"concat({', '.join(matches(r, k) for k, r in enumerate(rules))})").alias("found"))
        staged = scratch_dir(self.spark, "secret-scan")
        found.write.parquet(staged)
        found = self.spark.read.parquet(staged)
        rows = found.select("blob", F.expr("inline(found)"))
        before = Window.partitionBy("blob", "rule").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ended = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(before)).where("holds")
        named = F.expr(f"array({table})[rule]")
        ended.select("blob", named.alias("r"), (F.col("end") - F.col("len")).alias("start"), "end").select(
            "blob", "r.kind", "r.version", "start", "end"
        ).write.mode("append").parquet(f"{self.folder}/findings")
        done = found.select("blob", F.explode("todo").alias("rule")).select("blob", named.alias("r")).select("blob", "r.kind", "r.version")
        done.write.mode("append").parquet(f"{self.folder}/scanned")


def joined_spans(condition: str) -> str:
    return f"concat_ws(',', transform(filter(found, x -> {condition}), x -> concat(x.kind, ':', x.start, ':', x.end)))"


def scan_paths(spark: SparkSession, documents: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``documents``: doc_id, blob, counts per rule ``n_<kind>``, and spans as text."""
    ledger.scan(documents, rules)
    order = "CASE kind " + " ".join(f"WHEN '{r.kind}' THEN {k}" for k, r in enumerate(rules)) + " END"
    current = " OR ".join(f"(kind = '{r.kind}' AND version = {r.version})" for r in rules)
    findings = ledger.findings().where(current).groupBy("blob")
    by_blob = findings.agg(F.expr(f"array_sort(collect_list(struct(start, {order} AS rule, end, kind)))").alias("found"))
    paths = documents.select("doc_id", F.expr("unhex(sha2(coalesce(text, ''), 256))").alias("blob")).join(by_blob, "blob", "left")
    paths = paths.withColumn("found", F.coalesce("found", F.expr("cast(array() AS array<struct<start: bigint, rule: int, end: bigint, kind: string>>)")))
    base = sum(r.base for r in rules)
    counts = [F.expr(f"cast(size(filter(found, x -> x.kind = '{r.kind}')) AS bigint)").alias(f"n_{r.kind}") for r in rules]
    return paths.select(
        "doc_id", F.hex("blob").alias("blob"), *counts, F.expr(f"sha2({joined_spans(f'x.rule < {base}')}, 256)").alias("base_sha256"), F.expr(joined_spans("true")).alias("spans")
    )
