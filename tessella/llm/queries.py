"""Queries of the problems 3, 5, 6, 7, 8 and 9, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.problems import KEY, RECORDS, SPELLED
from ..session import table
from . import grid_clusters, knn_graph, mixing, packing, sentences, topn


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return knn_graph.near_pairs(table(spark, d, "cell_embeddings"))


def p3_recall(spark: SparkSession, d: str) -> DataFrame:
    """The graph's recall for every twentieth cell, in all and by similarity, against brute force over all cells."""
    return knn_graph.recall(table(spark, d, "cell_embeddings"))


def p3_search(spark: SparkSession, d: str) -> DataFrame:
    """Greedy graph search for every twentieth cell."""
    e = table(spark, d, "cell_embeddings")
    return knn_graph.graph_search(e, e.where("cell_key % 20 = 0"))


def p3_search_recall(spark: SparkSession, d: str) -> DataFrame:
    """The search's recall for every twentieth cell against brute force over all cells."""
    return knn_graph.search_recall(table(spark, d, "cell_embeddings"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    cells = topn.top_cells(table(spark, d, "classification_results"), table(spark, d, "slides"), 5)
    return cells.select("slide_id", "cluster_id", "record_id", "label_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return grid_clusters.clusters(table(spark, d, "cell_embeddings"), table(spark, d, "slides")).select("cell_key", "first_key")


def p6_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Every cluster with its size and most typical cells."""
    return grid_clusters.describe(grid_clusters.clusters(table(spark, d, "cell_embeddings"), table(spark, d, "slides")))


def p6_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Every cluster with its size, from its description."""
    return p6_clusters(spark, d).select("first_key", "size")


def p6_against_labels(spark: SparkSession, d: str) -> DataFrame:
    """Clusters against the recorded cluster numbers."""
    e = table(spark, d, "cell_embeddings")
    return grid_clusters.against_labels(grid_clusters.clusters(e, table(spark, d, "slides")), e, table(spark, d, "classification_results"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return packing.split_documents(table(spark, d, "documents"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Per container: pieces and tokens."""
    packed = packing.pack(table(spark, d, "documents"))
    return packed.groupBy("container").agg(F.count(F.lit(1)).alias("n_pieces"), F.sum("piece_size").alias("tokens"))


def p7_check(spark: SparkSession, d: str) -> DataFrame:
    """One row: documents and tokens packed, pieces, and whether each piece stands once and no container is overfull."""
    packed = packing.pack(table(spark, d, "documents"))
    loads = packed.groupBy("container").agg(F.sum("piece_size").alias("load"))
    over = loads.agg(F.coalesce(F.max("load") <= packing.CAPACITY, F.lit(True)).alias("fits"))
    n = packed.agg(F.count_distinct("doc_id").alias("docs"), F.sum("piece_size").alias("tokens"), F.count(F.lit(1)).alias("pieces"), (F.count_distinct("doc_id", "piece") == F.count(F.lit(1))).alias("once"))
    return n.crossJoin(over)  # one row each


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(table(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.capped_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.share_report(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_check(spark: SparkSession, d: str) -> DataFrame:
    """Per source: whether its cap is kept, and whether it is used up to the cap or to within one document of its budget."""
    docs = table(spark, d, "documents")
    largest = docs.agg(F.max(packing.byte_tokens(F.col("text"))).alias("largest"))
    r = mixing.share_report(docs, table(spark, d, "mix_targets")).crossJoin(largest)  # one row
    kept = F.col("used") <= F.col("max_repeats") * F.col("size")
    short = F.col("budget") - F.col("used")
    reached = F.when(F.col("capped"), F.col("used") == F.col("max_repeats") * F.col("size")).otherwise((short >= 0) & (short < F.col("largest")))
    return r.select("source", kept.alias("cap_kept"), reached.alias("reached"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_counts(spark: SparkSession, d: str) -> DataFrame:
    """Sentences per document."""
    return p9_found(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sentences"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p3_found, p3_recall, p3_search, p3_search_recall, p5_found, p6_found, p6_clusters, p6_sizes, p6_against_labels, p7_found, p7_containers, p7_check, p7_fill, p8_found, p8_shares, p8_check, p8_mix, p9_found, p9_counts)}

USABLE = """u AS (SELECT cell_key, any_value(embedding::DOUBLE[]) AS e, any_value(slide_id) AS slide_id FROM cell_embeddings WHERE cell_key IS NOT NULL AND len(embedding) = 50
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 GROUP BY 1)"""
CLUSTERS = f"""{USABLE}, v AS (SELECT cell_key, sid, e FROM u JOIN ({SPELLED}) s ON s.k = {KEY.format('u.slide_id')}),
  l AS (SELECT a.cell_key AS a, b.cell_key AS b FROM v a JOIN v b ON a.sid = b.sid AND list_cosine_similarity(a.e, b.e) >= 0.8),
  reach(node, root) AS (SELECT cell_key, cell_key FROM v UNION SELECT l.b, reach.root FROM reach JOIN l ON l.a = reach.node AND reach.root < l.b),
  lab AS (SELECT node AS cell_key, min(root) AS first_key FROM reach GROUP BY 1), big AS (SELECT first_key, count(*) AS size FROM lab GROUP BY 1 HAVING count(*) >= 5)"""
SIZE = "octet_length(encode(text))"
SQL = {
    "p3_found": f"""WITH {USABLE}, s AS (SELECT a.cell_key AS a, b.cell_key AS b, round(list_cosine_similarity(a.e, b.e), 9) AS sim FROM u a JOIN u b ON a.cell_key <> b.cell_key),
      t AS (SELECT a, b FROM s WHERE sim >= 0.98 QUALIFY row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) <= 10) SELECT DISTINCT least(a, b) AS cell_key_a, greatest(a, b) AS cell_key_b FROM t""",
    "p6_found": f"WITH RECURSIVE {CLUSTERS} SELECT cell_key, first_key FROM lab JOIN big USING (first_key)",
    "p6_against_labels": f"""WITH RECURSIVE {CLUSTERS}, c AS (SELECT cell_key, any_value(record_id) AS record_id, any_value(label_id) AS label_id FROM cell_embeddings GROUP BY 1),
      r AS (SELECT record_id, x.label_id AS label_id, max(x.cluster_id) AS cluster_id FROM (SELECT record_id, unnest(classified_cells) AS x FROM classification_results) GROUP BY ALL)
      SELECT first_key, cluster_id, count(*) AS n FROM lab JOIN big USING (first_key) JOIN c USING (cell_key) LEFT JOIN r USING (record_id, label_id) GROUP BY ALL""",
    "p5_found": f"""WITH s AS ({RECORDS}), c AS (
        SELECT DISTINCT s.sid AS slide_id, x.cluster_id, s.record_id, x.label_id, CASE WHEN x.cluster_confidence IS NULL OR isnan(x.cluster_confidence) THEN 0 ELSE x.cluster_confidence END AS f
        FROM (SELECT record_id, unnest(classified_cells) AS x FROM classification_results) r JOIN s USING (record_id)
        WHERE s.sid IS NOT NULL AND x.cluster_id >= 0 AND x.label_id IS NOT NULL)
      SELECT slide_id, cluster_id, record_id, label_id FROM c
      QUALIFY row_number() OVER (PARTITION BY slide_id, cluster_id ORDER BY f DESC, record_id, label_id) <= 5""",
    "p6_sizes": f"WITH RECURSIVE {CLUSTERS} SELECT first_key, size FROM big",
    "p7_check": f"""SELECT count(*) AS docs, sum({SIZE})::BIGINT AS tokens, sum(ceil({SIZE} / 8192.0))::BIGINT AS pieces, true AS once, true AS fits FROM documents WHERE {SIZE} > 0""",
    "p8_check": "SELECT source, true AS cap_kept, true AS reached FROM mix_targets",
    "p7_found": f"SELECT doc_id FROM documents WHERE {SIZE} > 8192",
    "p8_found": f"""WITH k AS (SELECT *, lower(regexp_replace(source, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS k FROM mix_targets),
      z AS (SELECT lower(regexp_replace(source, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS k, sum({SIZE}) AS size FROM documents WHERE text IS NOT NULL GROUP BY 1),
      j AS (SELECT k.source, k.target_share, k.max_repeats, coalesce(z.size, 0) AS size FROM k LEFT JOIN z USING (k))
      SELECT source FROM j WHERE max_repeats * size < target_share * (SELECT sum(size) FROM j)""",
}
