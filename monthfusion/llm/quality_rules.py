"""Quality rules that vote or abstain, combined by a label model (native).

Every rule looks at one statistic of a document and votes good (1), bad (-1) or
abstains (0).  No labels are used: expectation-maximisation over the table of
vote patterns estimates how often each rule votes which way on good and on bad
documents, and a document is kept by its posterior probability of being good.

* Statistics come from one pass over the texts, in SQL expressions; they are
  written to the shared folder, so texts are read once.
* EM works on vote patterns and their counts, at most ``3 ** len(RULES)`` rows
  whatever the input; each iteration is one Spark aggregate that returns one row.
* The posterior is a sum of literal weights per vote: no join.

Defined cases: NULL, empty and blank texts have no words, all statistics 0, and
fail the base rule.  Repeated rows and tied ids are rows of their own, with equal
verdicts.  An empty table gives an empty result.  Columns beside ``doc_id`` and
``text`` are ignored by ``document_votes`` and kept by ``keep_good``.
A very long text is one row, and
its statistics cover all of it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.llm.sqltext import BLANKS, let, words
from monthfusion.sources.scratch import scratch_dir

@dataclass(frozen=True)
class Rule:
    """Bad where ``bad`` holds, else good where ``good`` holds, else no vote."""

    name: str
    bad: str
    good: str = "false"


#: Thresholds on statistics per word or per line.  Junk is of many kinds, and a
#: document of one kind looks sound to the rules for the others; so those rules
#: reject or abstain, and only length speaks for a document.
RULES = (
    Rule("length", "n_words < 20", "n_words >= 200"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    Rule("symbols", "100 * n_symbols > 20 * n_words"),
    Rule("marks", "100 * n_symbols > 3 * word_chars"),
    Rule("repetition", "100 * n_repeat_words > 35 * n_words"),
    Rule("lines", "n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("capitals", "100 * n_upper > 40 * word_chars"),
    Rule("variety", "100 * n_distinct < 5 * n_words"),
)


def repeated_words(words_name: str) -> str:
    """Number of words within three-word windows that occur twice or more.

    Windows are sorted as one long each, a hash prefix and the position.  Only
    neighbours with equal prefixes are then compared by their words, so the count
    is exact and the work is n log n for any text.
    """
    w = words_name
    same = "(x.k = get(g, i - 1).k OR x.k = get(g, i + 1).k)"
    covered = let(
        "p",
        f"array_sort(transform(filter(g, (x, i) -> {same}), x -> x.p))",
        "aggregate(transform(p, (x, i) -> least(3L, coalesce(get(p, i + 1), x + 3L) - x)), 0L, (a, x) -> a + x)",
    )
    by_text = let("g", f"sort_array(transform(c, x -> struct(concat_ws(' ', slice({w}, cast(x + 1 AS int), 3)) AS k, x AS p)))", covered)
    near = "(get(s, i + 1) - x < m OR x - get(s, i - 1) < m)"
    candidates = let("c", f"transform(filter(s, (x, i) -> {near}), x -> x & (m - 1L))", f"if(size(c) = 0, 0L, {by_text})")
    # Two bits fewer keep the difference of two such numbers within a long.
    packed = f"transform(slice({w}, 1, size({w}) - 2), (x, i) -> (shiftright(xxhash64(x, {w}[i + 1], {w}[i + 2]), 2) & -m) | i)"
    return f"if(size({w}) < 4, 0L, " + let("m", f"cast(pow(2, ceil(log2(size({w}) + 1))) AS bigint)", let("s", f"sort_array({packed})", candidates)) + ")"


def statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``documents`` and one struct ``stats``; one pass, no shuffle."""
    t = f"coalesce({text}, '')"
    lines = f"filter(split({t}, '\n'), x -> btrim(x, '{BLANKS}') != '')"

    fields = {
        "n_words": "cast(size(w) AS bigint)",
        "word_chars": "cast(length(array_join(w, '')) AS bigint)",
        "n_symbols": f"cast(regexp_count({t}, r'[#*$%&|<>]') AS bigint)",
        "n_dup_lines": "cast(size(l) - size(array_distinct(l)) AS bigint)",
        "n_repeat_words": repeated_words("w"),
        "n_lines": "cast(size(l) AS bigint)",
        "n_distinct": "cast(size(array_distinct(w)) AS bigint)",
        "n_upper": rf"cast(regexp_count({t}, r'\p{{Lu}}') AS bigint)",
    }
    struct = "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"
    return documents.withColumn("stats", F.expr(let("w", words(text), let("l", lines, struct))))


def votes(rules: tuple[Rule, ...] = RULES) -> list[Column]:
    return [F.expr(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END").alias(f"vote_{r.name}") for r in rules]


@dataclass(frozen=True)
class LabelModel:
    """Chance of a good document, and of each vote of each rule given the class."""

    prior: float = 0.8
    good: dict[str, dict[int, float]] = field(default_factory=dict)
    bad: dict[str, dict[int, float]] = field(default_factory=dict)

    @classmethod
    def start(cls, rules: tuple[Rule, ...]) -> LabelModel:
        """Before any data: a rejection is rarely wrong, silence says little."""
        good, bad = {}, {}
        for r in rules:
            speaks = 0.6 if r.good != "false" else 0.0
            good[r.name] = {-1: 0.005, 0: 0.995 - speaks, 1: speaks}
            bad[r.name] = {-1: 0.2, 0: 0.8 - 0.8 * speaks, 1: 0.8 * speaks}
        return cls(0.8, good, bad)

    def log_odds(self) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, good in self.good.items():
            weight = {v: math.log(max(good[v], 1e-9) / max(self.bad[name][v], 1e-9)) for v in (-1, 0, 1)}
            vote = F.col(f"vote_{name}")
            total = total + F.when(vote == -1, weight[-1]).when(vote == 1, weight[1]).otherwise(weight[0])
        return total

    def probability(self) -> Column:
        """Posterior chance that a document with these votes is good."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.log_odds()))


def fit(voted: DataFrame, rules: tuple[Rule, ...] = RULES, iterations: int = 20, weight: float = 0.01) -> LabelModel:
    """EM over vote patterns.  The starting table counts as ``weight`` of the rows,
    which keeps the two classes from trading places."""
    names = [f"vote_{r.name}" for r in rules]
    spark = voted.sparkSession
    folder = scratch_dir(spark, "vote-patterns")
    counted = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    counted.coalesce(1).write.parquet(folder)
    # The patterns are few whatever the rows; one part needs no exchange in any round.
    patterns = spark.read.schema(counted.schema).parquet(folder).coalesce(1)
    model = start = LabelModel.start(rules)
    for _ in range(iterations):
        weighted = patterns.select("*", (F.col("n") * model.probability()).alias("g")).withColumn("b", F.col("n") - F.col("g"))
        sums = [F.sum("g").alias("g"), F.sum("b").alias("b")]
        for r in rules:
            for v in (-1, 0, 1):
                for part in "gb":
                    sums.append(F.sum(F.when(F.col(f"vote_{r.name}") == v, F.col(part)).otherwise(0.0)).alias(f"{r.name} {v} {part}"))
        row = weighted.agg(*sums).first()
        if row["g"] is None:
            return start
        total = row["g"] + row["b"]
        extra = weight * total

        def chances(side: dict[str, dict[int, float]], part: str) -> dict[str, dict[int, float]]:
            return {
                r.name: {v: (row[f"{r.name} {v} {part}"] + extra * side[r.name][v]) / (row[part] + extra) for v in (-1, 0, 1)}
                for r in rules
            }

        new = LabelModel((row["g"] + extra * start.prior) / (total + extra), chances(start.good, "g"), chances(start.bad, "b"))
        moved = abs(new.prior - model.prior)
        model = new
        if moved < 1e-6:
            break
    return model


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def document_votes(spark: SparkSession, documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, statistics and votes, written once to the shared folder."""
    folder = scratch_dir(spark, "document-votes")
    stats = statistics(documents.select("doc_id", "text")).select("doc_id", "stats.*")
    voted = stats.select("*", *votes(rules), F.expr(BASE_FAILED).alias("base_failed"))
    voted.write.parquet(folder)
    return spark.read.schema(voted.schema).parquet(folder)


def judge(spark: SparkSession, documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per document: statistics, votes, ``quality`` (posterior) and ``kept``."""
    voted = document_votes(spark, documents)
    quality = fit(voted).probability()
    return voted.withColumn("quality", quality).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def keep_good(spark: SparkSession, documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents`` that are kept, columns unchanged.

    The votes of a row follow from its own text, so the second pass computes them
    again beside the row instead of joining on an id that may repeat.
    """
    quality = fit(document_votes(spark, documents)).probability()
    columns = [F.col(f"row.`{c}`").alias(c) for c in documents.columns]
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col("text"))
    judged = statistics(rows).select("row", "stats.*").select("*", *votes(), F.expr(BASE_FAILED).alias("base_failed"))
    return judged.where(~F.col("base_failed") & (quality >= threshold)).select(*columns)
