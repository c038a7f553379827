"""MinHash near-duplicate detection.

One-permutation hashing: a document's distinct five-word shingles are hashed once
and dealt to ``BINS`` bins by the top of the hash; the least hash of a bin is its
entry.  An empty bin takes the entry of the first filled bin in a fixed random
order of its own (optimal densification).  ``ROWS`` entries make one of ``BANDS``
bucket keys.  In each bucket the least node is the centre, and only edges from the
centre to the others are candidates, so a bucket of n gives n - 1 pairs.

Then, exactly:

* equal sets (by a 128-bit sum and their size) are one node from the start, so
  groups of copies cost one row each;
* each candidate pair is compared on the full sets of both texts.  Before these are
  fetched, pairs go that cannot be links by two exact bounds: of the sizes, and of the
  sets' bitmaps, in which each shingle flips one of ``BITS`` bits: two bitmaps differ in
  no more bits than the sets differ in shingles;
* where a bucket still holds nodes of different components, one more round takes ``STARS``
  centres, of components that had none yet, and compares them with the members of all
  others.  What then is apart is compared pair by pair across components.  The bounds are
  part of the joins that make these pairs, so only pairs that may be links become rows, and
  a pair that was compared before is not compared again.  The steps are the same at
  every size (those after a round only follow if it found a link), and no bucket is cut
  or skipped.  One round for all centres keeps the jobs few, each of which costs the driver
  memory;
* components are joined by the large-star, small-star method, each step written to
  the shared folder.

With 64 bands of 6 a pair of similarity 0.75 meets in a bucket with chance
1 - (1 - 0.75^6)^64 > 0.99999.

Defined cases: NULL, empty and blank texts have an empty set and are linked with
nothing.  Texts of fewer than five words are one shingle.  Rows that share an id
are documents of their own; equal rows have equal results.  NULL ids are left out
of the least id of a component, unless it has no other.  Other columns are not read,
whatever their names.  A very long text is
hashed in blocks; only its set of shingles is held at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthfusion.llm.batches import give_back, small_batches
from monthfusion.llm.words import mix, numbers, shingle_sets
from monthfusion.sources.scratch import scratch_dir
from monthfusion.sources.shipping import ship_package

BANDS, ROWS = 64, 6
BINS = BANDS * ROWS
#: Further centres of a bucket before all that is still apart is compared.
STARS = 3
#: Bits of a bitmap, in longs of 64.
BITS = 1024
#: Different ends of text hashes.
ENDS = 1 << 20
#: Rows of pairs and labels that a task takes, and the least number of tasks.
ROWS_PER_TASK, LEAST_TASKS = 20_000, 8
#: A link needs PERCENT * union <= 100 * intersection.
PERCENT = 75


@cache
def probes() -> np.ndarray:
    """For each bin the order in which it looks for a filled one."""
    return np.argsort(numbers(BINS * BINS, 3).reshape(BINS, BINS), axis=1)


_ROW_WEIGHTS = numbers(ROWS, 4) | np.uint64(1)
_BAND_SALTS = numbers(BANDS, 5)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Least hash per bin, empty bins filled; ``hashes`` sorted and not empty."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    filled = np.zeros(BINS, bool)
    values = np.zeros(BINS, np.uint64)
    at = bins[first].astype(np.int64)
    filled[at], values[at] = True, hashes[first]
    empty = np.flatnonzero(~filled)
    for width in (8, BINS):
        if not len(empty):
            break
        order = probes()[empty, :width]
        hits = filled[order]
        found = hits.argmax(axis=1)
        done = hits[np.arange(len(empty)), found]
        values[empty[done]] = values[order[done, found[done]]]
        empty = empty[~done]
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((values.reshape(BANDS, ROWS) * _ROW_WEIGHTS).sum(axis=1, dtype=np.uint64) ^ _BAND_SALTS).view(np.int64)


SKETCH = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("n_shingles", pa.int64()),
        ("set_a", pa.int64()),
        ("set_b", pa.int64()),
        ("bands", pa.list_(pa.int64())),
        ("map", pa.list_(pa.int64())),
    ]
)
SKETCH_DDL = "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, bands array<long>, map array<long>"


def lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))


def bitmap(hashes: np.ndarray) -> np.ndarray:
    odd = np.bincount((hashes & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, sums, bands, maps, none = [], ([], []), [], [], np.zeros(0, np.int64)
        for hashes in shingle_sets(batch.column("text")):
            n.append(len(hashes))
            with np.errstate(over="ignore"):
                sums[0].append(int(mix(hashes).sum(dtype=np.uint64).astype(np.int64)))
                sums[1].append(int(mix(hashes ^ _BAND_SALTS[0]).sum(dtype=np.uint64).astype(np.int64)))
            bands.append(band_keys(signature(hashes)) if len(hashes) else none)
            maps.append(bitmap(hashes) if len(hashes) else none)
        ids = batch.column("doc_id").cast(pa.int64())
        columns = [ids, batch.column("text_hash"), pa.array(n, pa.int64()), *(pa.array(s, pa.int64()) for s in sums), lists(bands), lists(maps)]
        yield pa.RecordBatch.from_arrays(columns, schema=SKETCH)
    give_back()


def keyed(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))


PAIR_DDL = "a long, b long"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are similar enough; rows come sorted by ``a``."""
    last, last_set = None, None
    for batch in batches:
        kept = []
        for k, (a, other) in enumerate(zip(batch.column("a").to_pylist(), shingle_sets(batch.column("text_b")), strict=True)):
            if a != last:
                last, last_set = a, next(shingle_sets(batch.column("text_a").slice(k, 1)))
            if 100 * min(len(last_set), len(other)) < PERCENT * max(len(last_set), len(other)):
                continue
            both = len(np.intersect1d(last_set, other, assume_unique=True))
            if 100 * both >= PERCENT * (len(last_set) + len(other) - both):
                kept.append(k)
        yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(kept, pa.int64())) for c in ("a", "b")], names=["a", "b"])
    give_back()


#: At most so many shingles are in one of two linked sets only, so not more bits differ.
DIFFERENT = " + ".join(f"bit_count(a_map[{k}] ^ b_map[{k}])" for k in range(BITS // 64))
MAY_LINK = (
    f"100 * least(a_n, b_n) >= {PERCENT} * greatest(a_n, b_n)"
    f" AND {100 + PERCENT} * ({DIFFERENT}) <= {100 - PERCENT} * (a_n + b_n)"
)


STAR_DDL = "key long, node long, center long"


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, node); a key may begin or end in another task.

    Every node but the first of a key gets that first node as its centre.  The first
    nodes of this task's first and last key are also handed on alone, without centre.
    """

    def rows(keys, nodes, centers) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(nodes, pa.int64()), pa.array(centers, pa.int64())], names=["key", "node", "center"])

    opened, last, head = None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, nodes = (batch.column(c).to_numpy() for c in ("key", "node"))
        new = np.concatenate(([last is None or keys[0] != last], keys[1:] != keys[:-1]))
        at = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
        heads = np.where(at >= 0, nodes[at], nodes[0] if head is None else head)
        if last is None:
            opened = int(keys[0])
            yield rows([opened], [int(nodes[0])], [None])
        yield rows(keys[~new], nodes[~new], heads[~new])
        last, head = int(keys[-1]), int(heads[-1])
    if last is not None and last != opened:
        yield rows([last], [head], [None])
    give_back()


class NearDuplicates:
    """The steps of one run; every table named here lies in the shared folder."""

    def __init__(self, spark: SparkSession, documents: DataFrame):
        ship_package(spark)
        self.spark = spark
        self.folder = scratch_dir(spark, "near-duplicates")
        self.documents = keyed(documents)
        self.step, self.parts = 0, 1
        self.compared: list[str] = []

    def few(self, df: DataFrame) -> DataFrame:
        """Tables of pairs and labels are small beside the texts: fewer tasks, by their rows."""
        return df.coalesce(self.parts)

    def save(self, df: DataFrame, batch_rows: int = 1000) -> DataFrame:
        self.step += 1
        path = f"{self.folder}/{self.step}"
        with small_batches(self.spark, batch_rows):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_pairs(self, pairs: DataFrame) -> DataFrame:
        """Pairs that are compared next."""
        saved = self.save(self.few(pairs))
        self.compared.append(f"{self.folder}/{self.step}")
        return saved

    def sketches(self) -> DataFrame:
        return self.save(self.documents.mapInArrow(_sketch, SKETCH_DDL))

    def nodes(self, sketches: DataFrame) -> DataFrame:
        """One row for each distinct set, with the text that stands for it."""
        sets = sketches.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles")
        same = [F.any_value(c).alias(c) for c in ("bands", "map")]
        one = sets.agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "text_hash")).alias("rep"), *same)
        return self.save(one.withColumn("node", F.monotonically_increasing_id()))

    def buckets(self, nodes: DataFrame) -> DataFrame:
        """(key, node, center) for every node that shares a bucket, centres left out.

        Ranges of (key, node) are dealt to tasks, so a crowded bucket is spread over
        several; each part has its own centre, and the parts' centres get a star too.
        """
        rows = nodes.select("node", F.explode("bands").alias("key"))
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = rows.repartitionByRange(tasks, "key", "node").sortWithinPartitions("key", "node")
        stars = self.save(dealt.mapInArrow(_stars, STAR_DDL), batch_rows=10_000)
        parts = stars.where("center IS NULL").select("key", "node")  # two rows for each task
        first = parts.groupBy("key").agg(F.min("node").alias("center"))
        return stars.where("center IS NOT NULL").unionByName(parts.join(first, "key").where("node != center"))

    def bounded(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """The pairs (a, b), once each, that two exact bounds leave: of the sizes, and of
        the bitmaps.  ``a`` may be a centre of very many pairs, so it is joined last."""
        told = nodes.select("node", "n_shingles", "map")
        for side in ("b", "a"):
            named = told.select(F.col("node").alias(side), F.col("n_shingles").alias(f"{side}_n"), F.col("map").alias(f"{side}_map"))
            pairs = self.few(pairs.join(named, side))
        return self.save_pairs(pairs.where(MAY_LINK).select("a", "b").distinct())

    def texts(self, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
        """(node, text) for the nodes of some pairs.

        Only documents whose text hash ends as that of a wanted one are moved.  The ends
        are at most ENDS numbers, however many nodes are wanted, so they can be sent to all
        tasks; the documents left are joined by moving them, at every size.
        """
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        reps = self.save(self.few(nodes.join(wanted, "node").select("node", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash"))))
        ends = reps.select((F.col("rep_hash").bitwiseAND(ENDS - 1)).cast("int").alias("end")).distinct()
        near = self.documents.join(F.broadcast(ends), F.col("text_hash").bitwiseAND(ENDS - 1).cast("int") == F.col("end"), "left_semi")
        same = near["doc_id"].eqNullSafe(reps["rep_id"]) & (near["text_hash"] == reps["rep_hash"])
        # Repeated rows are combined only now: most documents share no bucket.
        return self.save(near.join(reps.hint("merge"), same).groupBy("node").agg(F.any_value("text").alias("text")))

    def verify(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Of saved pairs (a, b) within the bounds those that are links.  ``a`` may be a centre of
        very many pairs: its text is joined last, so that Spark can split the key, and hashed
        once per run."""
        texts = self.texts(nodes, pairs)
        b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        return self.save(self.few(self.few(pairs.join(b, "b")).join(a, "a")).select("a", "b", "text_a", "text_b").mapInArrow(_verify, PAIR_DDL))

    def components(self, links: DataFrame) -> DataFrame:
        """(node, label): the least node of its component, for nodes with links.

        Ends when every edge leads from a node with no other edge to a root.
        """
        edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
        while True:
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = self.few(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
            large = self.save(self.few(large))
            down = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(down, "u").select(F.explode(F.expr("array(struct(u AS u, m AS v), struct(v AS u, m AS v))")).alias("e"))
            edges = self.save(self.few(self.few(small.select("e.*").where("u != v")).distinct()))
            ends = edges.selectExpr("inline(array(struct(u AS node, 1 AS up, 0 AS down), struct(v AS node, 0 AS up, 1 AS down)))")
            ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            if self.few(ends.where("up > 1 OR up > 0 AND down > 0")).isEmpty():
                return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))

    def labelled(self, rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
        renamed = labels.select(F.col("node").alias(column), F.col("label").alias(f"{column}_label"))
        joined = rows.join(renamed, column, "left")
        return joined.withColumn(f"{column}_label", F.coalesce(f"{column}_label", column))

    def contracted(self, labels: DataFrame, links: DataFrame) -> DataFrame:
        """What is known, one edge for each node, and new links."""
        return labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(links)

    def search(self, nodes: DataFrame) -> DataFrame:
        """(node, label) by all links found."""
        rows = self.buckets(nodes)
        self.parts = max(LEAST_TASKS, rows.count() // ROWS_PER_TASK)
        pairs = rows.select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
        labels = self.components(self.verify(self.bounded(pairs, nodes), nodes))
        # Buckets whose star left members apart: only they are looked at again.
        known = self.labelled(self.labelled(rows.select("key", F.col("center").alias("a"), F.col("node").alias("b")), labels, "a"), labels, "b")
        keys = known.where("a_label != b_label").select("key").distinct()
        left = rows.join(keys, "key")
        members = self.save(left.select("key", "node").unionByName(left.select("key", F.col("center").alias("node"))).distinct())
        apart = self.apart(members, labels)
        if STARS and not apart.isEmpty():
            more = self.joined(labels, self.crossing(apart, nodes, self.centers(members, apart, labels)), nodes)
            if more is not labels:
                labels, apart = more, self.apart(members, more)
        return labels if apart.isEmpty() else self.joined(labels, self.crossing(apart, nodes), nodes)

    def centers(self, members: DataFrame, apart: DataFrame, labels: DataFrame) -> DataFrame:
        """(key, node): the next centres of each bucket, the least nodes of STARS components
        that had none.  Tasks keep STARS nodes of a bucket before any is moved for it."""
        # The first centre of a bucket is its least node.
        first = members.groupBy("key").agg(F.min("node").alias("node"))
        had = self.labelled(first, labels, "node").select("key", "node_label")
        ones = apart.groupBy("key", "node_label").agg(F.min("node").alias("node")).join(had, ["key", "node_label"], "left_anti")
        ranked = ones.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("node")))
        return self.save(self.few(ranked.where(F.col("rank") <= STARS).select("key", "node")))

    def joined(self, labels: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """The labels by what is known and the links among ``pairs``; the same if there are none."""
        if pairs.isEmpty():
            return labels
        links = self.verify(pairs, nodes)
        return labels if links.isEmpty() else self.components(self.contracted(labels, links))

    def apart(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """(key, node, node_label) of the buckets that hold several components."""
        known = self.save(self.few(self.labelled(members, labels, "node")))
        several = known.groupBy("key").agg(F.min("node_label").alias("least"), F.max("node_label").alias("most")).where("least != most")
        return self.save(self.few(known.join(several.select("key"), "key")))

    def crossing(self, apart: DataFrame, nodes: DataFrame, centers: DataFrame | None = None) -> DataFrame:
        """Pairs (a, b) across components that share a bucket, that the bounds leave and that
        were not compared before; with ``centers`` (key, node) only those whose ``a`` is one."""
        told = nodes.select("node", F.col("n_shingles").alias("n"), "map")
        rows = apart.join(told, "node")
        if centers is None:
            rows = first = rows.withColumn("center", F.lit(True))
        else:
            rows = rows.join(centers.withColumn("center", F.lit(True)), ["key", "node"], "left")
            first = rows.where("center")
        one, two = (df.select("key", *(F.col(c).alias(f"{side}_{c}") for c in ("node", "node_label", "n", "map", "center"))) for side, df in (("a", first), ("b", rows)))
        once = "(b_center IS NULL OR a_node < b_node) AND "
        met = one.withColumnRenamed("key", "a_key").join(two, F.expr(f"a_key = key AND {once}a_node_label != b_node_label AND {MAY_LINK}"))
        pairs = met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()
        before = self.spark.read.schema(PAIR_DDL).parquet(*self.compared).selectExpr("least(a, b) AS low", "greatest(a, b) AS high")
        return self.save_pairs(pairs.join(before, F.expr("least(a, b) = low AND greatest(a, b) = high"), "left_anti"))

    def classes(self) -> DataFrame:
        """Per document: doc_id, text_hash, n_shingles, component_id, n_equal (rows with
        this id and text in its class) and ``kept``."""
        sketches = self.sketches()
        nodes = self.nodes(sketches)
        labelled = self.labelled(nodes.select("node", "doc_id", "set_a", "set_b", "n_shingles"), self.search(nodes), "node")
        least = labelled.groupBy("node_label").agg(F.min("doc_id").alias("component_id"))
        found = self.save(labelled.join(least, "node_label").select("set_a", "set_b", "n_shingles", "component_id", F.col("node_label").alias("component")))
        docs = sketches.select("doc_id", "text_hash", "set_a", "set_b", "n_shingles")
        joined = docs.join(found, ["set_a", "set_b", "n_shingles"], "left")
        joined = joined.withColumn("component_id", F.coalesce("component_id", "doc_id"))
        return joined.select("doc_id", "text_hash", "n_shingles", "component", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_duplicates(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """One row per document: its class (``component_id``) and whether it is kept."""
    return NearDuplicates(spark, documents).classes()


def keep_one(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """One row of ``documents`` of each class, the least id, columns unchanged.

    Among rows of one class with that same id the text with the least hash stays, and
    of equal rows one; only rows that repeat are grouped for this.
    """
    classes = near_duplicates(spark, documents).where("kept")
    # A document without words is a class of its own.
    first = F.min(F.struct("text_hash"))
    chosen = classes.groupBy("component", "component_id", F.when(F.col("component").isNull(), F.col("text_hash")).alias("own"))
    chosen = chosen.agg(first.alias("first"))
    counts = classes.groupBy(F.col("doc_id").alias("keep_id"), F.col("text_hash").alias("keep_hash")).agg(F.count(F.lit(1)).alias("n_rows"))
    keep = chosen.select(F.col("component_id").alias("keep_id"), F.col("first.text_hash").alias("keep_hash"))
    same_key = keep["keep_hash"] == counts["keep_hash"]
    keep = keep.join(counts, same_key & keep["keep_id"].eqNullSafe(counts["keep_id"])).select(keep["keep_id"], keep["keep_hash"], "n_rows")
    folder = scratch_dir(spark, "kept-documents")
    keep.write.parquet(folder)
    keep = spark.read.schema(keep.schema).parquet(folder)
    text_hash = F.xxhash64(F.coalesce(documents["text"], F.lit("")))
    columns = [documents[f"`{c}`"] for c in documents.columns]
    joined = documents.join(keep, (text_hash == keep["keep_hash"]) & documents["doc_id"].eqNullSafe(keep["keep_id"]))
    rows = joined.select(F.struct(*columns).alias("row"), "keep_id", "keep_hash", "n_rows")
    once = rows.where("n_rows = 1").select("row")
    several = rows.where("n_rows > 1").groupBy("keep_id", "keep_hash").agg(F.any_value("row").alias("row")).select("row")
    return once.unionByName(several).select(*[F.col(f"row.`{c}`").alias(c) for c in documents.columns])
