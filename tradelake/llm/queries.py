"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import alignment, ann, clusters, decontaminate, licenses, mixing, parity, pii, simhash, sql, substring, suffix_dedup, toxicity, warc
from tradelake.llm.common import read

#: Key of the registered query's pseudonyms; a real run passes its own secret.
PII_KEY = "registered query"
#: Folder of the tokenizer files.
TOKENIZERS = "/opt/tokenizers"
#: Labelled documents that the domain classifier learns from at most.
LABELLED = 20_000

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", "text", toxicity.is_held_out(F.col("doc_id")).alias("held_out"))
    return toxicity.score(rows, model).drop("text")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def _removed() -> F.Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]).alias("n_removed")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    kept = suffix_dedup.deduplicate(docs)
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return kept.select("doc_id", F.col("n").alias("n_bytes"), _removed(), n_spans, F.sha2("kept", 256).alias("kept_sha256"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    kept = substring.deduplicate(docs)
    return kept.select("doc_id", F.col("n").alias("n_words"), _removed(), F.sha2("kept", 256).alias("kept_sha256"))


def labelled_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``text`` and ``domain``, language and quality, of LABELLED documents that have a quality label.

    They are those of the smallest id hashes; as their number is bounded, their labels are sent to
    the texts and no text moves.
    """
    labels = read(spark, sf_dir, "labels").where("doc_id IS NOT NULL AND quality IS NOT NULL")
    labels = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    labels = F.broadcast(labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED))
    quality = F.when(F.col("quality") > 0, "good").otherwise("poor")
    return (
        docs.select("doc_id", "text", "lang")
        .where("lang IS NOT NULL")
        .join(labels, "doc_id")
        .select("text", F.concat_ws("-", "lang", quality).alias("domain"))
    )


def domain_weights(model: mixing.Classifier) -> dict[str, float]:
    """Half of the tokens English, the rest evenly; nine in ten of each from good texts."""
    languages = {d.rsplit("-", 1)[0] for d in model.domains}
    share = {x: 0.5 if x == "en" else 0.5 / max(1, len(languages - {"en"})) for x in languages}
    return {d: share[d.rsplit("-", 1)[0]] * (0.9 if d.endswith("good") else 0.1) for d in model.domains}


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = mixing.fit_classifier(labelled_domains(spark, docs, sf_dir), domain_col="domain")
    docs = docs.select("doc_id", "text")
    return mixing.mix(docs, model, domain_weights(model), with_text=False)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a folder a source, language and hundred ids, of which the first speaks."""
    docs = read(spark, sf_dir, "documents")
    name = F.when(F.col("doc_id") % 100 < 5, F.concat(F.lit("LICENSE."), "doc_id")).otherwise(F.concat("doc_id", F.lit(".txt")))
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), name)
    return licenses.scan(docs.select("doc_id", "text", path.alias("path"))).drop("text")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    files = (f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
    return alignment.align(docs, *files, digest=True).withColumnRenamed("groups", "groups_sha256")


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = clusters.cluster(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return rows.drop("embedding")


def op13_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return parity.similar(docs).select("doc_id", "n_shingles", "component_id")


def queries() -> dict[str, Query]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_toxicity": op2_toxicity,
        "op3_simhash": op3_simhash,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_warc": op5_warc,
        "op6_substring": op6_substring,
        "op7_mixing": op7_mixing,
        "op8_pii": op8_pii,
        "op9_licenses": op9_licenses,
        "op10_nearest": op10_nearest,
        "op11_align": op11_align,
        "op12_clusters": op12_clusters,
        "op13_similar": op13_similar,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": sql.OP1, "op5_warc": sql.OP5, "op6_substring": sql.OP6, "op12_clusters": sql.OP12}
