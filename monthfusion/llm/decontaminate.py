"""Benchmark decontamination by SimHash of item-sized windows (native).

A document is contaminated by an item if some window of as many words as the item
has a weighted five-word-shingle similarity of at least ``SIMILARITY`` with it.

1. A window can reach that only if it shares a shingle with an item of its length.  One
   pass over the words of all documents, in generated code, joins every rolling shingle
   hash with the places of shingles in items of each length; a match of document position
   p and place q sets the window of that length that starts at p - q.  Which item it was
   is not kept.  Of a run of matches on one diagonal only the first is.
2. Windows and items get SimHash fingerprints of ``BITS`` bits of their weighted shingles.
3. Multi-index: a fingerprint is cut into ``BLOCKS`` blocks of nine or ten bits.  If two
   fingerprints differ in at most RADIUS = BLOCKS * (NEAR + 1) - 1 bits, some block
   differs in at most NEAR.  So each item is entered, for each block, with all values
   within NEAR bits of its own, and windows find items of their length by equal (length,
   block, bits): no item within the radius is missed.  A similarity of 0.75 gives some
   22 differing bits of 128, with a standard deviation of 4.3, which leaves 3.7 of these.
4. What is left is compared exactly: the weight shared over the weight of both,
   a shingle's weight being its number of characters.

Places of items' shingles are broadcast up to ``BROADCAST_ROWS`` rows (some 100 MB);
beyond, Spark joins by shuffle, which it can split for hot shingles, of positions, not of texts.

Defined cases: NULL and empty texts have no words and are clean; items without
words match nothing; items of fewer than five words are one shingle.  Windows at a
document's edge are cut there.  Repeated rows give one row per (doc_id, item_id)
with the best window; the same for items that share an id.  NULL ids are kept as
NULL.  A very long text is one row of a scan; only its windows go further.  Other columns
are not read, whatever their names; ``drop_contaminated`` keeps them.  Empty tables give
an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.llm.sqltext import let, plain_words, run_hash
from monthfusion.sources.scratch import scratch_dir

SHINGLE = 5
SIMILARITY = 0.75
WIDTH = 64
BITS = 2 * WIDTH
BLOCKS, NEAR = 13, 2
RADIUS = BLOCKS * (NEAR + 1) - 1
BROADCAST_ROWS = 2_000_000

#: First bit and length of the blocks.
CUTS = [(BITS * k // BLOCKS, BITS * (k + 1) // BLOCKS - BITS * k // BLOCKS) for k in range(BLOCKS)]


def shingle_texts(words_name: str) -> str:
    """Distinct shingles of a word array as texts; words hold no blanks."""
    w = words_name
    span = f"least({SHINGLE}, size({w}))"
    every = f"transform(sequence(1, size({w}) - {span} + 1), x -> concat_ws(' ', slice({w}, x, {span})))"
    return f"if(size({w}) = 0, cast(array() AS array<string>), array_distinct({every}))"


def fingerprint(shingles_name: str) -> str:
    """SimHash as two longs: bit b is set if the shingles whose hash has it weigh more than the others."""
    halves = []
    for half in "vu":
        vote = f"aggregate(h, 0, (a, x) -> a + if(getbit(x.{half}, b) = 1, x.w, -x.w))"
        halves.append(f"aggregate(sequence(0, {WIDTH - 1}), 0L, (f, b) -> f | if({vote} > 0, shiftleft(1L, b), 0L))")
    return let("h", f"transform({shingles_name}, x -> struct(xxhash64(x) AS v, xxhash64(1, x) AS u, length(x) AS w))", f"array({', '.join(halves)})")


def with_fingerprint(df: DataFrame) -> DataFrame:
    """Adds ``shingles`` and ``fingerprint`` to a table with ``words``."""
    both = let("s", shingle_texts("words"), f"struct(s AS shingles, {fingerprint('s')} AS fingerprint)")
    return df.withColumn("both", F.expr(both)).select(*df.columns, "both.*")


def items_of(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(F.col("item_id"), F.expr(plain_words("text")).alias("words")).where("size(words) > 0")
    return with_fingerprint(items).withColumn("item", F.monotonically_increasing_id())


def places(items: DataFrame, spark: SparkSession) -> DataFrame:
    """(hash, hash_before, span, n, q): where shingles stand in items of n words."""
    span = f"least({SHINGLE}, n)"
    own = items.select(F.col("words").alias("item_words"), F.expr("size(words)").alias("n"), F.posexplode("words").alias("q", "word"))
    rows = own.where(f"q <= n - {span}").select("n", "q", F.expr(span).alias("span"), *[F.expr(f"{of_span('item_words', at, span)}").alias(c) for c, at in (("hash", "q"), ("before", "q - 1"))])
    folder = scratch_dir(spark, "item-shingles")
    rows.select("n", "q", "span", "hash", F.expr("if(q = 0, NULL, before)").alias("hash_before")).distinct().write.parquet(folder)
    return spark.read.parquet(folder)


def of_span(words_name: str, at: str, span: str) -> str:
    """Hash of ``span`` words from ``at``, for a span of 1 to SHINGLE words that a row tells."""
    cases = " ".join(f"WHEN {k} THEN {run_hash(words_name, at, k)}" for k in range(1, SHINGLE))
    return f"CASE {span} {cases} ELSE {run_hash(words_name, at, SHINGLE)} END"


def windows(documents: DataFrame, items: DataFrame, spark: SparkSession) -> DataFrame:
    """(doc_id, text_hash, n, start, words): windows as long as items of n words that share
    a shingle with one; at a document's edge they have fewer words."""
    docs = documents.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.expr(plain_words("text")).alias("words")
    )
    shingles = places(items, spark)
    spans = sorted(r[0] for r in shingles.select("span").distinct().collect())  # at most SHINGLE rows
    if not spans:
        return docs.select("doc_id", "text_hash", F.lit(0).alias("n"), F.lit(0).alias("start"), "words").limit(0)
    hashes = ", ".join(run_hash("words", "p", k) for k in spans)
    rolling = docs.select("doc_id", "text_hash", "words", F.posexplode("words").alias("p", "word"))
    if len(spans) > 1:
        rolling = rolling.select("doc_id", "text_hash", "words", "p", F.expr(f"explode(array({hashes}))").alias("hash"))
    else:
        rolling = rolling.withColumn("hash", F.expr(hashes))
    if shingles.count() <= BROADCAST_ROWS:
        shingles = F.broadcast(shingles)
        first = f"hash_before IS NULL OR p = 0 OR {of_span('words', 'p - 1', 'span')} != hash_before"
        matches = rolling.join(shingles, "hash").where(f"p <= size(words) - span AND ({first})")
    else:  # rows that move have no words; they get them back by the few documents with matches
        found = rolling.where("p <= size(words)").drop("words", "word").join(shingles, "hash").select("doc_id", "text_hash", "p", "q", "n", "span").distinct()
        again = docs.dropDuplicates(["doc_id", "text_hash"]).withColumnsRenamed({"doc_id": "again_id", "text_hash": "again_hash"})
        same = (F.col("text_hash") == F.col("again_hash")) & F.col("doc_id").eqNullSafe(F.col("again_id"))
        matches = found.join(again, same).where("p <= size(words) - span")
    cut = matches.select("doc_id", "text_hash", "n", F.expr("p - q").alias("start"), F.expr("slice(words, greatest(p - q, 0) + 1, n + least(p - q, 0))").alias("words"))
    return cut.groupBy("doc_id", "text_hash", "n", "start").agg(F.any_value("words").alias("words"))


def block(fingerprint_name: str, at: int, n: int) -> str:
    """The ``n`` bits from bit ``at``, which may lie in both longs."""
    long, low = divmod(at, WIDTH)
    bits = f"shiftrightunsigned({fingerprint_name}[{long}], {low})"
    if low + n > WIDTH:
        bits = f"({bits} | shiftleft({fingerprint_name}[{long + 1}], {WIDTH - low}))"
    return f"{bits} & {(1 << n) - 1}L"


def masks(n: int) -> list[int]:
    """All numbers of ``n`` bits of which at most NEAR are set."""
    return [sum(1 << b for b in some) for k in range(NEAR + 1) for some in combinations(range(n), k)]


def own_blocks() -> str:
    parts = [f"struct({k} AS block, {block('fingerprint', at, n)} AS bits)" for k, (at, n) in enumerate(CUTS)]
    return f"inline(array({', '.join(parts)}))"


def near_blocks() -> str:
    """Every block with all values within NEAR bits of it."""
    parts = []
    for k, (at, n) in enumerate(CUTS):
        flips = ", ".join(f"{m}L" for m in masks(n))
        parts.append(let("v", block("fingerprint", at, n), f"transform(array({flips}), m -> struct({k} AS block, v ^ m AS bits))"))
    return f"inline(flatten(array({', '.join(parts)})))"


def contaminated(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, first_word, n_words), best window of each pair."""
    folder = scratch_dir(spark, "decontamination")
    items_of(benchmark).write.parquet(f"{folder}/items")
    items = spark.read.parquet(f"{folder}/items")
    cut = with_fingerprint(windows(documents, items, spark)).withColumn("window", F.monotonically_increasing_id())
    cut.write.parquet(f"{folder}/windows")
    found = spark.read.parquet(f"{folder}/windows")
    left = found.select("window", "n", "fingerprint", F.expr(own_blocks()))
    right = items.select("item", F.expr("size(words)").alias("n"), F.col("fingerprint"))
    right = right.select("item", "n", F.col("fingerprint").alias("item_fingerprint"), F.expr(near_blocks()))
    apart = " + ".join(f"bit_count(fingerprint[{k}] ^ item_fingerprint[{k}])" for k in range(BITS // WIDTH))
    near = left.join(right, ["n", "block", "bits"]).where(f"{apart} <= {RADIUS}")
    pairs = near.select("window", "item").distinct()
    item_sets = items.select("item", "item_id", F.col("shingles").alias("item_shingles"))
    weighed = pairs.join(found.drop("n", "fingerprint"), "window").join(item_sets, "item")

    def weight(shingles: str) -> str:
        return f"aggregate({shingles}, 0D, (a, x) -> a + length(x))"

    scored = weighed.withColumn(
        "similarity", F.expr(f"{weight('array_intersect(shingles, item_shingles)')} / {weight('array_union(shingles, item_shingles)')}")
    ).where(f"similarity >= {SIMILARITY}")
    best = F.struct("similarity", (-F.col("start")).alias("back"), F.size("words").alias("n_words"))
    grouped = scored.groupBy("doc_id", "text_hash", "item_id").agg(F.max(best).alias("best"))
    return grouped.select(
        "doc_id", "text_hash", "item_id", F.col("best.similarity").alias("similarity"),
        F.greatest(-F.col("best.back"), F.lit(0)).cast("bigint").alias("first_word"), F.col("best.n_words").cast("bigint").alias("n_words"),
    )


def drop_contaminated(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold no benchmark item, columns unchanged."""
    folder = scratch_dir(spark, "contaminated")
    contaminated(spark, documents, benchmark).select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct().write.parquet(folder)
    bad = spark.read.parquet(folder)
    same = (F.xxhash64(F.coalesce(documents["text"], F.lit(""))) == bad["bad_hash"]) & documents["doc_id"].eqNullSafe(bad["bad_id"])
    return documents.join(bad, same, "left_anti")
