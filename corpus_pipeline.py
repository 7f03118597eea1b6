"""A training corpus from raw documents, in five stages that each apply one operator.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept.  All but the
last return the columns of ``documents``; the last adds ``tokens``, ``domain``, ``rate`` and
``copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import decontaminate, mixing, pii, simhash, toxicity
from tradelake.llm.common import quoted, read, stored
from tradelake.llm.queries import PII_KEY, domain_weights, labelled_domains


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents that the factorization machine predicts toxic."""
    return toxicity.accepted(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each group of near copies by op3's rule."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of whose words one in twenty is part of a benchmark item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts pseudonyms in the texts; ``n_chars`` follows where an address changed its length."""
    changed = pii.pseudonymise(docs.withColumn("_n", F.length("text")), PII_KEY)
    n_chars = F.col("n_chars") + F.coalesce(F.length("text") - F.col("_n"), F.lit(0))
    return changed.withColumn("n_chars", n_chars).select([quoted(c) for c in docs.columns])


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates that bring the domains' tokens to their target weights; rows drawn no time go."""
    model = mixing.fit_classifier(labelled_domains(spark, docs, sf_dir), domain_col="domain")
    return mixing.mix(docs, model, domain_weights(model)).where("copies > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", hide_personal),
    ("mixing", mix_domains),
]

#: The models of the first and last stage cannot be put as SQL; tests hold the rows against
#: plain implementations instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
