"""Queries on document rules, lineage and digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ensemblage.operators import audit, lineage
from ensemblage.plans.adapters import Given
from ensemblage.plans.catalog import register
from ensemblage.plans.oracle import with_ctes
from ensemblage.sources import documents

CHAIN = {
    "runs": """
        SELECT conv_id || '/' || turn AS run, CASE WHEN turn > 0 THEN conv_id || '/' || (turn - 1) END AS upstream,
               length(text) <= 400 AS ok FROM conversations""",
    "walk": """
        SELECT run, run AS node, 0::BIGINT AS depth FROM runs
        UNION ALL
        SELECT w.run, r.upstream, w.depth + 1 FROM walk w JOIN runs r ON w.node = r.run
        WHERE r.upstream IN (SELECT run FROM runs)""",
}


@register("dq_manifest_rules", """
    SELECT '/m/' || o_orderkey AS manifest_path, place, field, problem
    FROM orders JOIN (VALUES ('manifest', 'schema', 'unknown'), ('manifest', 'cwd', 'missing'), ('manifest', 'failures', 'missing'),
         ('manifest', 'failures', 'wrong_type'), ('inputs', 'raw_argv', 'missing'), ('artifacts', 'accepted', 'wrong_type'),
         ('artifacts', 'array', 'wrong_type')) p(place, field, problem) ON o_orderstatus = 'P'
    UNION ALL
    SELECT '/m/' || o_orderkey, 'artifacts', 'x_' || o_orderkey, 'wrong_type' FROM orders WHERE o_orderstatus = 'P'""")
def manifest_rules(spark: SparkSession, folder: str) -> DataFrame:
    return audit.envelope_problems(Given(spark, folder).screen_texts())


@register("dq_screen_contract", """
    SELECT '/m/' || o_orderkey AS manifest_path, place, field, problem
    FROM orders JOIN (VALUES ('P', NULL, 'inputs', 'n_input', 'missing'), ('P', NULL, 'inputs', 'n_accepted', 'missing'),
         ('P', NULL, 'inputs', 'n_rejected', 'missing'), ('P', NULL, 'artifacts', 'accepted', 'missing'),
         ('P', NULL, 'artifacts', 'rejected', 'missing'), ('P', NULL, 'manifest', 'ok', 'true_without_accepted'),
         ('P', NULL, 'manifest', 'failures', 'missing'),
         ('O', NULL, 'inputs', 'n_accepted', 'disagrees_with_bucket'), ('O', NULL, 'inputs', 'best_chosen_by', 'missing'),
         ('O', NULL, 'xyz[0]', 'label', 'wrong_label'),
         ('OF', '1-URGENT', 'accepted[0]', 'index', 'below_one'), ('OF', '2-HIGH', 'accepted', 'index', 'not_unique'),
         ('OF', '3-MEDIUM', 'accepted[1]', 'energy_kcal', 'wrong_type'), ('OF', '3-MEDIUM', 'accepted[1]', 'cluster_id', 'wrong_type'),
         ('OF', '4-NOT SPECIFIED', 'rejected[0]', 'sha256', 'missing'),
         ('OF', '4-NOT SPECIFIED', 'rejected[0]', 'rel_energy_kcal', 'only_for_accepted'),
         ('OF', '4-NOT SPECIFIED', 'rejected[0]', 'rejected_reason', 'missing'), ('OF', '5-LOW', 'inputs', 'method', 'not_resolved')
        ) p(status, priority, place, field, problem)
      ON contains(status, o_orderstatus) AND (priority IS NULL OR priority = o_orderpriority)""")
def screen_contract(spark: SparkSession, folder: str) -> DataFrame:
    return audit.screen_problems(Given(spark, folder).screen_texts())


@register("dq_failure_status", """
    SELECT '/m/' || o_orderkey AS manifest_path, CASE o_orderstatus WHEN 'P' THEN 8 ELSE 0 END::BIGINT AS n_failures,
           o_orderstatus <> 'P' AS ok
    FROM orders""")
def failure_status(spark: SparkSession, folder: str) -> DataFrame:
    texts = Given(spark, folder).screen_texts()
    runs = texts.select("manifest_path", F.lit(True).alias("ok"))
    return audit.status_with_failures(runs, audit.envelope_problems(texts))


@register("dq_recorded_failures", """
    SELECT '/m/' || o_orderkey AS manifest_path, CASE o_orderstatus WHEN 'O' THEN 2 ELSE 0 END::BIGINT AS n_failures, o_orderstatus = 'F' AS ok
    FROM orders""")
def recorded_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Runs by the failures that their own manifests record."""
    read = documents.manifests(Given(spark, folder).manifest_texts())
    return audit.status_with_failures(read, documents.failures(read))


@register("lin_upstream_chain", with_ctes("""
    SELECT run, max(depth) AS depth, arg_max(node, depth) AS root FROM walk GROUP BY run""", CHAIN))
def chain(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.upstream_chain(Given(spark, folder).runs()).select("run", "depth", "root")


@register("lin_failed_ancestors", with_ctes("""
    SELECT w.run, arg_min(w.node, w.depth) AS failed, min(w.depth) AS failed_depth
    FROM walk w JOIN runs r ON w.node = r.run WHERE w.depth > 0 AND NOT r.ok GROUP BY w.run""", CHAIN))
def failed_ancestors(spark: SparkSession, folder: str) -> DataFrame:
    found = lineage.upstream_chain(Given(spark, folder).runs())
    return found.where(F.col("failed").isNotNull()).select("run", "failed", "failed_depth")


@register("lin_hash_drift", """
    SELECT '/d/' || doc_id AS path_abs, CASE WHEN lang = 'en' THEN sha256(text || ' ') ELSE sha256(text) END AS sha256,
           sha256(text) AS present, lang = 'en' AS drifted
    FROM documents""")
def drift(spark: SparkSession, folder: str) -> DataFrame:
    texts = Given(spark, folder).table("documents")
    path = F.concat(F.lit("/d/"), F.col("doc_id").cast("string"))
    old = F.when(F.col("lang") == "en", F.concat("text", F.lit(" "))).otherwise(F.col("text"))
    recorded = texts.select(path.alias("path_abs"), F.sha2(F.encode(old, "UTF-8"), 256).alias("sha256"))
    return lineage.hash_drift(recorded, texts.select(path.alias("path_abs"), F.col("text").alias("content")))


@register("lin_duplicate_content", """
    SELECT sha256(text) AS sha256, count(*) AS n_paths, min('/d/' || doc_id) AS first_path
    FROM documents GROUP BY text HAVING count(*) > 1""")
def duplicates(spark: SparkSession, folder: str) -> DataFrame:
    texts = Given(spark, folder).table("documents")
    path = F.concat(F.lit("/d/"), F.col("doc_id").cast("string"))
    return lineage.duplicate_content(texts.select(path.alias("path_abs"), F.col("text").alias("content")))


@register("fn_sha256", "SELECT page_id, sha256(html) AS sha256 FROM pages")
def digests(spark: SparkSession, folder: str) -> DataFrame:
    return Given(spark, folder).table("pages").select("page_id", F.sha2(F.encode("html", "UTF-8"), 256).alias("sha256"))
