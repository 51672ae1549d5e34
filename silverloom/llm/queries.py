"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from silverloom.llm import ann, bpe, collocations, host_quality, html, jaccard, licenses, mixing, oracle, quality, secrets, sharding, token_counts, whitening
from silverloom.llm.common import materialize, table


def op1_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of all documents, written, and then three edits of each document applied to the stored trees."""
    spec = bpe.default_spec()
    trees = token_counts.build_trees(table(spark, sf_dir, "documents"), spec, extra=[token_counts.derived_edits().alias("edits")])
    return token_counts.apply_edits(materialize(trees, "token-trees"), F.col("edits"), spec, counts_only=True)


def op2_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op3_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 8)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def op5_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), bpe.default_spec())


def op6_mixing_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.withColumns({c: F.round(c, 6) for c in ("evidence", "host_mean", "path_mean", "posterior")})


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    joined = lambda xs, f: F.array_join(F.transform(xs, f), ",")
    each = lambda xs: joined(xs, lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, secrets.KINDS)), x.kind + 1), x.start, x.end))
    base = F.filter("found", lambda x: x.kind < 3)
    count = lambda test: F.size(F.filter("found", test)).cast("long")
    of_kind = lambda k: count(lambda x: x.kind == k)  # noqa: E731  a second argument of the inner one would be the place in the array
    kinds = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS)]
    return found.select(
        "doc_id", *kinds[:3], F.sha2(each(base), 256).alias("base_sha256"), each(F.col("found")).alias("spans"), kinds[3],
        count(lambda x: x.live).alias("n_live"), count(lambda x: ~x.live).alias("n_example"),
        joined("found", lambda x: F.when(x.live, "live").otherwise("example")).alias("verdicts"),  # span by span, as the two below
        joined("found", lambda x: x.owners.cast("string")).alias("owners"), joined("found", lambda x: x.repositories.cast("string")).alias("repositories"),
    )


def op9_html_tree_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract_text(pages, html.train(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard.link_components(table(spark, sf_dir, "documents"), n=3, percent=90)
    return linked.select("doc_id", "n_shingles", "component_id")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digests(licenses.find_licenses(table(spark, sf_dir, "documents")))


def op12_tiled_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = [op1_edit_aware_counts, op2_hash_prefix_forest, op3_minimax_shards, op4_quality_rules, op5_forced_boundary_bpe, op6_mixing_schedule, op7_host_quality, op8_secret_scan, op9_html_tree_model, op10_jaccard_join, op11_license_scan, op12_tiled_collocations, op13_block_whitening]
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = {"op4_quality_rules": oracle.OP4, "op12_tiled_collocations": oracle.OP12}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
