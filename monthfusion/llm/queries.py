"""Registered queries of the operators, and comparison SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfusion.llm import centroids, classifier, collocations, decontaminate, hidden_markov, licenses, minhash, mixing, packing, quality_rules, secrets, token_records, warc
from monthfusion.sources.scratch import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def production_encoding() -> token_records.Encoding:
    import public_tokenizers

    return token_records.Encoding(public_tokenizers.path("byte_bpe_50k.json"), 2)


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-records")
    index = token_records.write_records(spark, table(spark, sf_dir, "documents"), folder, production_encoding())
    return token_records.read_files(spark, index)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(spark, table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("quality"))


def op3_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    taken = mixing.with_copies(documents, mixing.mix(spark, documents))
    return taken.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("mix_taken") * F.col("mix_size")).alias("taken"),
    )  # fmt: skip


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", "first_word", "n_words")).alias("best")).select("doc_id", "item_id", "best.*")


def op8_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = secrets.Ledger(spark, scratch_dir(spark, "secret-ledger"))
    found = secrets.scan_paths(spark, table(spark, sf_dir, "documents"), ledger)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op9_license_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark, table(spark, sf_dir, "documents"))


def op10_warc_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(spark, table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    return warc.read_archives(spark, archives)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.scores(spark, table(spark, sf_dir, "documents"))


def op11_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    encoding = token_records.Encoding(public_tokenizers.path("word_bpe_49k.json"), 1)
    sequences = packing.write_sequences(spark, table(spark, sf_dir, "documents"), scratch_dir(spark, "packed"), encoding)
    return packing.read_pieces(sequences, encoding)


def op12_table_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(spark, table(spark, sf_dir, "embeddings"))


def op13_filter_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, table(spark, sf_dir, "documents"))


def centroid_sql(k: int = centroids.CENTROIDS, rounds: int = centroids.ROUNDS) -> str:
    """The clustering with distances multiplied out, for tables without repeated ids."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        d{r} AS (
            SELECT vec_id, any_value(x) AS x, min(struct_pack(d := d, c := c)) AS best
            FROM (SELECT vec_id, x, c, CAST(list_sum(list_transform(list_zip(x, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{r})
            GROUP BY vec_id)""")
        if r < rounds:
            steps.append(f"""
        s{r} AS (
            SELECT c, list(CAST(CASE WHEN t % n < 0 THEN t // n - 1 ELSE t // n END AS BIGINT) ORDER BY i) AS m
            FROM (SELECT best.c AS c, i, sum(x[i]) AS t, count(*) AS n FROM d{r}, range(1, {centroids.COMPONENTS + 1}) AS dims(i) GROUP BY ALL)
            GROUP BY c),
        c{r + 1} AS (SELECT c{r}.c, coalesce(s{r}.m, c{r}.m) AS m FROM c{r} LEFT JOIN s{r} USING (c))""")
    return f"""
        WITH v AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda e: CAST(floor({centroids.SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE len(embedding) = {centroids.COMPONENTS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {centroids.COMPONENTS}),
        c0 AS (
            SELECT CAST(row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id)) - 1 AS INT) AS c, x AS m
            FROM v ORDER BY c LIMIT {k}),
        {",".join(steps)}
        SELECT vec_id, best.c AS cluster, best.d AS distance,
               CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM d{rounds} JOIN c{rounds} ON best.c = c{rounds}.c"""


def collocation_sql(least: int = collocations.LEAST, top: int = collocations.TOP) -> str:
    """The phrases counted as lists of words."""
    return rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')) AS piece
            FROM documents),
        runs AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
        counted AS (
            SELECT lang, p, count(*) AS f
            FROM (SELECT lang, w[i:i + k - 1] AS p
                  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM runs, range(1, {collocations.LONGEST + 1}) AS sizes(k)))
            GROUP BY ALL),
        totals AS (SELECT lang, sum(f) AS n FROM counted WHERE len(p) = 1 GROUP BY ALL),
        candidates AS (SELECT lang, p, f AS a FROM counted WHERE len(p) > 1 AND f >= {least}),
        cuts AS (
            SELECT c.lang, c.p, c.a, k, l.f AS l, r.f AS r, ({collocations.SCORE} * CAST(c.a AS HUGEINT)) // (l.f + r.f) AS score
            FROM (SELECT *, unnest(range(1, len(p))) AS k FROM candidates) c
            JOIN counted l ON l.lang = c.lang AND l.p = c.p[1:k]
            JOIN counted r ON r.lang = c.lang AND r.p = c.p[k + 1:len(c.p)]),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
        inner_runs AS (
            SELECT lang, p[i:i + k - 1] AS p, max(a) AS longer
            FROM (SELECT *, unnest(range(1, len(p) - k + 2)) AS i FROM (SELECT *, unnest(range(2, len(p))) AS k FROM candidates))
            GROUP BY ALL),
        ranked AS (
            SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
                   row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
            FROM lowest LEFT JOIN inner_runs USING (lang, p)
            WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < {collocations.CONTAINED} * CAST(a AS HUGEINT))
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN totals USING (lang) WHERE rank <= {top}"""


QUERIES = {
    "op1_token_records": op1_token_records,
    "op2_quality_rules": op2_quality_rules,
    "op3_pareto_mixing": op3_pareto_mixing,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_decontamination": op6_decontamination,
    "op8_secret_ledger": op8_secret_ledger,
    "op9_license_votes": op9_license_votes,
    "op10_warc_chains": op10_warc_chains,
    "op7_quality_classifier": op7_quality_classifier,
    "op4_hidden_markov": op4_hidden_markov,
    "op11_harmonic_packing": op11_harmonic_packing,
    "op12_table_centroids": op12_table_centroids,
    "op13_filter_collocations": op13_filter_collocations,
}

#: The other operators train, sample, tokenize or search by hashing, which this SQL cannot
#: express; tests hold them against plain versions.
ORACLES: dict[str, str] = {
    "op12_table_centroids": centroid_sql(),
    "op13_filter_collocations": collocation_sql(),
    "op10_warc_chains": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        sized AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS first_id
            FROM payloads)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM sized""",
}
