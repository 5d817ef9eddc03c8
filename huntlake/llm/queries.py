"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from huntlake.llm import best_fit, centroids, codes, decontaminate, language, neighbours, packing, pages, separators
from huntlake.llm import sharding, simhash, substrings, url_rules
from huntlake.llm.common import saved, table
from huntlake.sinks.shared import fresh_folder


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four fifths of them."""
    documents = table(spark, sf_dir, "documents")
    held_out = (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0).alias("held_out")
    filters = language.fit(documents.where(~held_out).select("doc_id", "text", "lang"))
    return language.predict(documents, filters).select("doc_id", held_out, "lang_pred", "score")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.keep_unique(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shuffled(sharding.document_rows(table(spark, sf_dir, "documents")))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat files that are first written from the table.

    A part of the table that one task reads becomes one file in the order of its
    rows, so the n-th document of a file is the n-th row of its part.
    """
    documents = table(spark, sf_dir, "documents")
    part = F.xxhash64(documents["_metadata.file_path"], documents["_metadata.file_block_start"]).cast("string")
    placed = documents.select(part.alias("shard"), F.col("_metadata.row_index").alias("place"), "doc_id", "text")
    row = Window.partitionBy("shard").orderBy("place")
    # written now: a scan made later might split the table in other places
    rows = saved(placed.select("shard", "doc_id", (F.row_number().over(row) - 1).cast("long").alias("ordinal")), "rows")
    path = fresh_folder(spark, "flat")
    separators.write_flat(placed, path)
    counted = separators.count_tokens(spark, path).withColumn("shard", F.regexp_extract("file", "shard=([^/]*)", 1))
    found = F.coalesce("n_tokens", F.raise_error(F.lit("a document is in no flat file")).cast("long")).alias("n_tokens")
    return rows.join(counted, ["shard", "ordinal"], "left").select("doc_id", found, "shard", "ordinal")


#: (verdict, host, path); fixed values of the query.
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "verdict string, host string, path string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.summarised(*centroids.cluster(table(spark, sf_dir, "embeddings")))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.summarised(*codes.compress(table(spark, sf_dir, "embeddings")))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_decontamination": op2_decontamination,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_neighbours": op4_neighbours,
    "op5_simhash": op5_simhash,
    "op6_html_extraction": op6_html_extraction,
    "op7_sharding": op7_sharding,
    "op8_token_counts": op8_token_counts,
    "op9_packing": op9_packing,
    "op10_url_filters": op10_url_filters,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_vector_codes": op13_vector_codes,
}

#: Distinct shingles of five lower-case words of each item, and the documents that hold 80 % of an item's; shorter items as a whole.
DECONTAMINATION_SQL = """
WITH item_words AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM benchmark WHERE text IS NOT NULL
), items AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM item_words WHERE len(w) >= 5)
), sizes AS (
  SELECT item_id, count(*) AS n_shingles FROM items GROUP BY item_id
), doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents WHERE text IS NOT NULL
), docs AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc_words WHERE len(w) >= 5)
), held AS (
  SELECT doc_id, item_id, count(*) AS n_shared FROM docs JOIN items USING (shingle) GROUP BY doc_id, item_id
), short AS (
  SELECT DISTINCT item_id, ' ' || array_to_string(w, ' ') || ' ' AS whole FROM item_words WHERE len(w) BETWEEN 1 AND 4
)
SELECT DISTINCT doc_id, item_id, 1::BIGINT AS n_shingles, 1::BIGINT AS n_shared, 1::DOUBLE AS containment
FROM doc_words JOIN short ON contains(' ' || array_to_string(w, ' ') || ' ', whole)
UNION ALL
SELECT doc_id, item_id, n_shingles, n_shared, n_shared::DOUBLE / n_shingles AS containment
FROM held JOIN sizes USING (item_id)
WHERE n_shared >= ceil(n_shingles * 0.8 - 1e-9)
"""

#: Each rule tried on each URL; the longest that fits wins.
URL_SQL = """
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
), judged AS (
  SELECT page_id, host, path, CASE
    WHEN ('.' || host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host LIKE '%.net') AND path LIKE '/%' THEN 'net/'
  END AS rule FROM parts
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

#: Windows of 13 words with the smallest document each starts in; a word goes if a window over it started earlier.
SUBSTRING_SQL = """
WITH split AS (
  SELECT doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS body
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM split WHERE len(w) >= 13)
), hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY body) AS first FROM windows)
  WHERE doc_id > first
), gone AS (
  SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS place FROM hit
), listed AS (
  SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id
), kept AS (
  SELECT split.doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
    CASE WHEN places IS NULL THEN w
      ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(places, x[2])), lambda x: x[1])
    END AS words
  FROM split LEFT JOIN listed USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
  sha256(array_to_string(words, ' ')) AS kept_sha256
FROM kept
"""

#: floor(total / count) of whole numbers; DuckDB's own division of integers truncates.
FLOOR_MEAN = "((s - ((s % n) + n) % n) // n)"


def _usable(scale: int, sized: str) -> str:
    """Vectors of finite numbers as integers, told apart by ``rid``."""
    return f"""
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::HUGEINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND {sized} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _apart(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def centroid_sql(clusters: int = centroids.CLUSTERS, rounds: int = centroids.ROUNDS, dims: int = centroids.DIMS) -> str:
    """Each round written out: every vector against every centroid, then the floors of the means."""
    steps = [
        f"kept AS MATERIALIZED ({_usable(centroids.SCALE, f'len(embedding) = {dims}')}\n)",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v
  FROM (SELECT sha256('{centroids.SALT}' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {clusters}) t
)""",
    ]
    for turn in range(rounds + 1):
        steps.append(f"""a{turn} AS MATERIALIZED (
  SELECT rid, vec_id, v, cluster, d FROM (
    SELECT rid, vec_id, v, cluster, d, row_number() OVER (PARTITION BY rid ORDER BY d, cluster) AS place
    FROM (SELECT rid, vec_id, kept.v AS v, cluster, {_apart('kept.v', f'c{turn}.v')} AS d FROM kept, c{turn}) t
  ) t WHERE place = 1
)""")
        if turn < rounds:
            steps.append(f"""c{turn + 1} AS MATERIALIZED (
  SELECT c{turn}.cluster, coalesce(m.v, c{turn}.v) AS v FROM c{turn} LEFT JOIN (
    SELECT cluster, list({FLOOR_MEAN} ORDER BY i) AS v FROM (
      SELECT cluster, i, sum(x) AS s, count(*) AS n
      FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, {dims + 1})) AS i FROM a{turn}) t GROUP BY cluster, i
    ) t GROUP BY cluster
  ) m ON m.cluster = c{turn}.cluster
)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT a.vec_id, a.cluster::INTEGER AS cluster, d::BIGINT AS distance,
  (sum(d) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.cluster
"""


def code_sql(entries: int = codes.ENTRIES, rounds: int = codes.ROUNDS, parts: int = codes.PARTS, width: int = 16) -> str:
    """Each round written out: every part against every entry of its position, then the floors of the means."""
    steps = [
        f"kept AS MATERIALIZED ({_usable(codes.SCALE, 'true')}\n)",
        f"""parts AS MATERIALIZED (
  SELECT rid, p, list_slice(v, p * {width} + 1, p * {width} + {width}) AS x FROM kept, (SELECT unnest(range({parts})) AS p) t
)""",
        f"""b0 AS MATERIALIZED (
  SELECT p, entry, list_slice(v, p * {width} + 1, p * {width} + {width}) AS v
  FROM (SELECT row_number() OVER (ORDER BY vec_id, v) - 1 AS entry, v
        FROM (SELECT vec_id, v FROM kept WHERE vec_id IS NOT NULL ORDER BY vec_id, v LIMIT {entries}) t) t,
    (SELECT unnest(range({parts})) AS p) u
)""",
    ]
    for turn in range(rounds + 1):
        steps.append(f"""a{turn} AS MATERIALIZED (
  SELECT rid, p, x, best.entry AS entry, best.d AS d FROM (
    SELECT rid, p, any_value(x) AS x, min({{'d': d, 'entry': entry}}) AS best
    FROM (SELECT rid, parts.p AS p, x, entry, {_apart('x', 'v')} AS d FROM parts JOIN b{turn} USING (p)) t GROUP BY rid, p
  ) t
)""")
        if turn < rounds:
            steps.append(f"""b{turn + 1} AS MATERIALIZED (
  SELECT b.p, b.entry, coalesce(m.v, b.v) AS v FROM b{turn} b LEFT JOIN (
    SELECT p, entry, list({FLOOR_MEAN} ORDER BY i) AS v FROM (
      SELECT p, entry, i, sum(y) AS s, count(*) AS n
      FROM (SELECT p, entry, unnest(x) AS y, unnest(range(1, {width + 1})) AS i FROM a{turn}) t GROUP BY p, entry, i
    ) t GROUP BY p, entry
  ) m ON m.p = b.p AND m.entry = b.entry
)""")
    return "WITH " + ",\n".join(steps) + f""",
coded AS (
  SELECT rid, string_agg(lower(printf('%02x', entry::INTEGER)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY rid
), book AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM b{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (rid), book
"""


ORACLES: dict[str, str] = {
    "op2_decontamination": DECONTAMINATION_SQL,
    "op3_substring_dedup": SUBSTRING_SQL,
    "op10_url_filters": URL_SQL,
    "op11_centroid_clustering": centroid_sql(),
    "op13_vector_codes": code_sql(),
}
