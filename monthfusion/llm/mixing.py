"""Mixing sources to target weights by Pareto order sampling (native).

Targets.  Sources share all words by weight; a source gets at most ``MOST`` times its
own words, and what it cannot take is shared again.  This has a closed form (``fill``):
sorted by cap over weight, the common level is the largest of what remains over the
weights that remain.

Copies.  Within a source a document's expected copies grow with its size class, at
most MOST, again by ``fill``, so that the expected words are the target.  Their whole
part is certain.  The rest is an inclusion probability p; documents are ranked by
their random odds over their inclusion odds, (u / (1 - u)) / (p / (1 - p)), and taken
in that order until the source's words are reached (a fixed size in words).  The
remaining gap is closed by the one document whose words come nearest to it.

At scale nothing sorts a source as a whole.  Ranks are dealt to ``BINS`` bins, one
aggregate sums words per source and bin, and only the bin in which a source reaches
its target is ordered.  What comes out is two small tables, one row per source and
size class and one per source; the decision on a row follows from them and the row
alone, so texts are neither shuffled nor joined by id.

The random number of a document is a hash of seed, id and text: reruns agree, however
rows are dealt to tasks.

Defined cases: NULL and empty texts have size 0 and are taken 0 times.  A NULL source
is a source, ordered last.  Repeated rows have equal ranks and are taken together.
Tied ranks otherwise are settled by id and text.  An empty table gives an empty
result.  A very long text is a document of its size class like others.  ``mixture`` keeps
all columns as they are, whatever their names; ``with_copies`` puts its figures in place of columns
that have their names (``mix_...``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthfusion.sources.scratch import scratch_dir

MOST = 3
BINS = 1 << 16
SEED = 20_240_229


def repeating_weights(rank: Column) -> Column:
    """Weights 1, 2, 3, repeating by rank from 1."""
    return (rank - 1) % 3 + 1


def longer_preferred(size_class: Column) -> Column:
    """How much a document of a size class (log2 of its words) is wanted."""
    return 1 + size_class / 8


def fill(df: DataFrame, group: list[str], weight: str, cap: str, total: str, name: str) -> DataFrame:
    """Adds ``name``: shares of ``total`` by weight, each at most its cap."""
    key = [F.col(c) for c in group] or [F.lit(0)]
    order = Window.partitionBy(*key).orderBy(F.col(cap) / F.col(weight), *[c for c in ("mix_source", "mix_class") if c in df.columns])
    before = F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum(weight).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = F.max("mix_level").over(Window.partitionBy(*key))
    leveled = df.withColumn("mix_level", (F.col(total) - before) / left)
    return leveled.withColumn(name, F.least(F.col(cap), level * F.col(weight))).drop("mix_level")


def prepared(documents: DataFrame) -> DataFrame:
    """Adds source, size, size class, hash of the text and a random number."""
    text = "coalesce(text, '')"
    size = F.expr(rf"cast(regexp_count({text}, r'[^\x20\x09-\x0D]+') AS bigint)")
    rows = documents.withColumns({"mix_source": F.col("source"), "mix_size": size, "mix_hash": F.expr(f"xxhash64({text})")})
    unit = F.expr(f"(shiftrightunsigned(xxhash64({SEED}, coalesce(doc_id, -1), doc_id IS NULL, mix_hash), 11) + 0.5D) / {1 << 53}D")
    return rows.withColumns({"mix_class": F.expr("cast(floor(log2(mix_size)) AS int)"), "mix_unit": unit})


def decided(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Adds certain copies, inclusion probability, rank and bin."""
    c = classes.select(F.col("mix_source").alias("c_source"), F.col("mix_class").alias("c_class"), "mix_copies")
    same = rows["mix_source"].eqNullSafe(c["c_source"]) & (rows["mix_class"] == c["c_class"])
    joined = rows.join(c, same, "left").drop("c_source", "c_class").withColumn("mix_copies", F.coalesce("mix_copies", F.lit(0.0)))
    joined = joined.withColumn("mix_sure", F.floor("mix_copies")).withColumn("mix_p", F.col("mix_copies") - F.col("mix_sure"))
    # The logarithm of random odds over inclusion odds.
    rank = F.when(F.col("mix_p") > 0, F.expr("ln(mix_unit / (1 - mix_unit)) - ln(mix_p / (1 - mix_p))"))
    return joined.withColumn("mix_rank", rank).withColumn("mix_bin", F.expr(f"cast(floor({BINS} / (1 + exp(-mix_rank))) AS int)"))


def join_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    t = table.withColumnRenamed("mix_source", "t_source")
    return rows.join(t, rows["mix_source"].eqNullSafe(t["t_source"]), "left").drop("t_source")


def picked() -> Column:
    return F.coalesce((F.col("mix_bin") < F.col("mix_cut")) | ((F.col("mix_bin") == F.col("mix_cut")) & (F.col("mix_rank") <= F.col("mix_last"))), F.lit(False))


def mix(
    spark: SparkSession,
    documents: DataFrame,
    weights: Callable[[Column], Column] = repeating_weights,
    preference: Callable[[Column], Column] = longer_preferred,
) -> tuple[DataFrame, DataFrame]:
    """The two tables that decide: copies per source and size class, cut per source."""
    folder = scratch_dir(spark, "mixing")

    def save(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    rows = save(prepared(documents).select("doc_id", *(f"mix_{c}" for c in ("source", "size", "class", "hash", "unit"))), "rows")
    words = save(rows.groupBy("mix_source", "mix_class").agg(F.sum("mix_size").alias("mix_words")), "words")
    sources = words.groupBy("mix_source").agg(F.sum("mix_words").alias("mix_source_size"))
    # One row for each source: these windows are over sources, not documents.
    rank = F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last()))
    total = F.sum("mix_source_size").over(Window.partitionBy(F.lit(0))).cast("double")
    sources = sources.withColumns({"mix_weight": weights(rank).cast("double"), "mix_total": total, "mix_cap": F.col("mix_source_size") * float(MOST)})
    targets = save(fill(sources, [], "mix_weight", "mix_cap", "mix_total", "mix_target").select("mix_source", "mix_source_size", "mix_target"), "targets")
    wanted = join_source(words.where("mix_words > 0"), targets).withColumns(
        {"mix_weight": preference(F.col("mix_class")) * F.col("mix_words"), "mix_cap": F.col("mix_words") * float(MOST)}
    )
    shares = fill(wanted, ["mix_source"], "mix_weight", "mix_cap", "mix_target", "mix_share")
    classes = save(shares.select("mix_source", "mix_class", (F.col("mix_share") / F.col("mix_words")).alias("mix_copies")), "classes")

    ranked = decided(rows, classes)
    sure = ranked.groupBy("mix_source").agg(F.sum(F.col("mix_sure") * F.col("mix_size")).alias("mix_certain"))
    goal = save(join_source(targets, sure).withColumn("mix_goal", F.col("mix_target") - F.col("mix_certain")), "goal")
    bins = ranked.where("mix_rank IS NOT NULL").groupBy("mix_source", "mix_bin").agg(F.sum("mix_size").alias("mix_words"))
    bins = bins.withColumn("mix_to", F.sum("mix_words").over(Window.partitionBy("mix_source").orderBy("mix_bin")))
    crossing = join_source(bins, goal.select("mix_source", "mix_goal")).where("mix_to > mix_goal AND mix_to - mix_words <= mix_goal")
    cuts = save(
        join_source(goal, crossing.select("mix_source", F.col("mix_bin").alias("mix_cut"), (F.col("mix_to") - F.col("mix_words")).alias("mix_below"))).withColumn(
            "mix_cut", F.coalesce("mix_cut", F.lit(BINS + 1))
        ),
        "cuts",
    )
    border = join_source(ranked, cuts.select("mix_source", "mix_cut", "mix_goal", "mix_below")).where("mix_bin = mix_cut")
    upto = F.sum("mix_size").over(Window.partitionBy("mix_source").orderBy("mix_rank").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    last = border.withColumn("mix_upto", upto).where("mix_below + mix_upto <= mix_goal").groupBy("mix_source").agg(F.max("mix_rank").alias("mix_last"))
    cuts = save(join_source(cuts, last), "cuts-and-ranks")

    taken = join_source(ranked, cuts.select("mix_source", "mix_cut", "mix_last")).withColumn("mix_taken", F.col("mix_sure") + picked().cast("long"))
    reached = taken.groupBy("mix_source").agg(F.sum(F.col("mix_taken") * F.col("mix_size")).alias("mix_reached"))
    gaps = join_source(cuts.select("mix_source", "mix_target"), reached).select("mix_source", (F.col("mix_target") - F.col("mix_reached")).alias("mix_gap"))
    gaps = save(gaps, "gaps")  # as a table its size is known, so documents are not dealt by source
    spare = taken.where(f"mix_taken < {MOST} AND mix_size > 0 AND mix_copies > 0").groupBy("mix_source", "doc_id", "mix_hash", "mix_unit").agg(F.sum("mix_size").alias("mix_more"))
    nearer = join_source(spare, gaps).where("abs(mix_gap - mix_more) < abs(mix_gap)")
    best = nearer.groupBy("mix_source").agg(F.min(F.struct(F.expr("abs(mix_gap - mix_more)"), "mix_unit", "doc_id", "mix_hash")).alias("mix_best"))
    extra = best.select("mix_source", F.col("mix_best.doc_id").alias("mix_extra_id"), F.col("mix_best.mix_hash").alias("mix_extra_hash"))
    cuts = save(join_source(cuts, extra).select("mix_source", "mix_source_size", "mix_target", "mix_cut", "mix_last", "mix_extra_id", "mix_extra_hash"), "decisions")
    return classes, cuts


def with_copies(documents: DataFrame, decisions: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Adds ``mix_taken`` (how often a row is taken), its size, and its source's figures."""
    classes, cuts = decisions
    rows = join_source(decided(prepared(documents), classes), cuts)
    extra = F.coalesce(F.col("doc_id").eqNullSafe(F.col("mix_extra_id")) & (F.col("mix_hash") == F.col("mix_extra_hash")), F.lit(False))
    return rows.withColumn("mix_taken", F.col("mix_sure") + picked().cast("long") + extra.cast("long"))


def mixture(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """The rows of ``documents``, each as often as the mix takes it, columns unchanged."""
    # Apart from the columns that decide, a row is one value, whatever its names.
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("mix_row")
    whole = documents.select("doc_id", "text", "source", row)
    rows = with_copies(whole, mix(spark, whole)).where("mix_taken > 0")
    repeated = rows.select("mix_row", F.expr("explode(sequence(1, cast(mix_taken AS int)))"))
    return repeated.select(*[F.col(f"mix_row.`{c}`").alias(c) for c in documents.columns])
