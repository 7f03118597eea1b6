"""Duplicates, conflicting revisions and warnings about a whole table.

"First", "last" and "latest" per key are ranked windows cut at one row.  Spark applies that cut
before the shuffle as well, so a key with most of the table's rows leaves every task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.schema import COMPOSITE_KEY, SEQ, key_columns, reading_order

_RANK = "_rank"


def _key(key: Sequence[str | Column]) -> list[Column]:
    """Key expressions; an absent second partner is the same as 0."""
    out: list[Column] = []
    for part in key:
        out += key_columns((part,)) if isinstance(part, str) else [part]
    return out


def pick_one(
    df: DataFrame, key: Sequence[str | Column], order: Sequence[Column]
) -> DataFrame:
    """The first row of each key in the given order.

    A hash of the key leads the window: the sort then compares one number, where the key's own
    parts, codes that most rows share, would be compared as texts row by row.
    """
    parts = _key(key)
    window = Window.partitionBy(F.xxhash64(*parts), *parts).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def first_wins(
    df: DataFrame,
    key: Sequence[str | Column] = COMPOSITE_KEY,
    *,
    order: Sequence[str] | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Keep the earliest row per key.  ``within`` limits the rule, e.g. to one response file."""
    return pick_one(df, [*key, *within], [F.col(c).asc() for c in order or reading_order(df)])


def last_wins(
    df: DataFrame,
    key: Sequence[str | Column] = COMPOSITE_KEY,
    *,
    order: Sequence[str] | None = None,
    keep_position: bool = False,
) -> DataFrame:
    """Keep the latest read row per key.

    With ``keep_position`` the row takes the row number at which its key was first met, so
    ordering by it gives first-seen key order.
    """
    kept = pick_one(df, key, [F.col(c).desc() for c in order or reading_order(df)])
    if not keep_position:
        return kept
    names = [f"_k{i}" for i in range(len(key))]
    met = (
        df.select(*[c.alias(n) for c, n in zip(_key(key), names)], SEQ)
        .groupBy(*names)
        .agg(F.min(SEQ).alias("_met"))
    )
    # Both sides hold one row per key, and key parts may be null.
    keyed = kept.select("*", *[c.alias(n) for c, n in zip(_key(key), names)])
    same = [keyed[n].eqNullSafe(met[n]) for n in names]
    joined = keyed.join(met, same).drop(*[met[n] for n in names])
    return joined.withColumn(SEQ, F.col("_met")).drop("_met", *names)


def latest_wins(
    df: DataFrame,
    key: Sequence[str | Column] = COMPOSITE_KEY,
    *,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the highest ``ref_period_id`` per key; absent is 0, ties go to the
    earlier row."""
    revision = F.coalesce(F.col("ref_period_id"), F.lit(0)).desc()
    return pick_one(df, key, [revision, *[F.col(c).asc() for c in order or reading_order(df)]])


def key_counts(df: DataFrame, key: Sequence[str | Column] = COMPOSITE_KEY) -> DataFrame:
    """Rows per key."""
    return df.groupBy(*_key(key)).agg(F.count(F.lit(1)).alias("member_count"))


def duplicate_keys(df: DataFrame, key: Sequence[str | Column] = COMPOSITE_KEY) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return key_counts(df, key).filter(F.col("member_count") > 1)


def duplicate_members(df: DataFrame, key: Sequence[str] = COMPOSITE_KEY) -> DataFrame:
    """All rows whose key occurs more than once, each with the size of its group.

    Groups stay rows, never a list in one row.  The counted side has one row per key, so a hot
    key on the row side can be split over tasks at run time (adaptive skew join).
    """
    names = [f"_k{i}" for i in range(len(key))]
    keyed = df.select("*", *[c.alias(n) for c, n in zip(_key(key), names)])
    repeated = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("member_count"))
    repeated = repeated.filter(F.col("member_count") > 1)
    same = [keyed[n].eqNullSafe(repeated[n]) for n in names]
    joined = keyed.join(repeated, same)
    return joined.select(*[keyed[c] for c in df.columns], "member_count")


#: How many positions one step of the order scan looks at together (2**20).
_STEP_BITS = 20


def count_decreases(df: DataFrame, value: str, order: str = SEQ) -> DataFrame:
    """How often ``value`` drops from one row to the next in reading order, nulls left out.

    The order is scanned in steps.  Each step takes runs of 2**20 neighbouring positions, counts
    the drops inside a run and keeps only the run's first and last value for the next step.  No
    task ever sees more than a run, and a run is bounded because positions are distinct after
    the first grouping.  Rows sharing a position are taken in ascending value.
    """
    runs = (
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(order).cast("bigint").alias("pos"))
        .agg(F.min(value).alias("head"), F.max(value).alias("tail"))
        .withColumn("drops", F.lit(0).cast("bigint"))
    )
    for _ in range(0, 64, _STEP_BITS):
        run = F.shiftright(F.col("pos"), _STEP_BITS).alias("run")
        runs = runs.select(run, "pos", "head", "tail", "drops")
        before = F.lag("tail").over(Window.partitionBy("run").orderBy("pos"))
        dropped = (F.col("before") > F.col("head")).cast("bigint")
        runs = (
            runs.withColumn("before", before)
            .groupBy("run")
            .agg(
                F.min_by("head", "pos").alias("head"),
                F.max_by("tail", "pos").alias("tail"),
                (F.sum("drops") + F.coalesce(F.sum(dropped), F.lit(0))).alias("drops"),
            )
            .withColumnRenamed("run", "pos")
        )
    return runs.agg(F.coalesce(F.sum("drops"), F.lit(0)).cast("bigint").alias("decreases"))


def dataset_warnings(df: DataFrame) -> DataFrame:
    """What is unusual about a table as a whole, one row per finding.

    More than one reporter, flow, classification or edition is worth a warning, and so is a
    reading order in which ``ref_period_id`` goes back.
    """
    aspects = ("reporter_code", "flow_code", "classification_code", "edition")
    combos = df.groupBy(*aspects).agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(a).alias("aspect"), F.col(a).cast("string").alias("member"))
                for a in aspects
            ]
        )
    )
    members = combos.select(pairs.alias("p")).select("p.*").filter(F.col("member").isNotNull())
    spans = (
        members.distinct()
        .groupBy("aspect")
        .agg(
            F.count(F.lit(1)).alias("found"),
            F.array_join(
                F.transform(
                    F.array_sort(
                        F.collect_list(
                            F.struct(F.col("member").try_cast("bigint"), F.col("member"))
                        )
                    ),
                    lambda m: m["member"],
                ),
                ", ",
            ).alias("members"),
        )
        .filter(F.col("found") > 1)
    )
    drops = (
        count_decreases(df, "ref_period_id")
        .filter(F.col("decreases") > 0)
        .select(
            F.lit("ref_period_id").alias("aspect"),
            F.col("decreases").alias("found"),
            F.lit(None).cast("string").alias("members"),
        )
    )
    return spans.unionByName(drops)


#: Columns that may identify a code-list entry, in order of preference.
# Fixed values.
CODE_COLUMNS = ("id", "code", "iso3", "iso_alpha3", "commodity_code")


def first_per_code(df: DataFrame, resource: str, *, order: Sequence[str]) -> DataFrame:
    """First entry per code of a code list; entries without any code count as one code."""
    known = [F.col(c).cast("string") for c in CODE_COLUMNS if c in df.columns]
    code = F.coalesce(*known) if known else F.lit(None).cast("string")
    kept = pick_one(df, [code], [F.col(c).asc() for c in order])
    return kept.withColumn("resource", F.lit(resource))


__all__ = [
    "count_decreases",
    "dataset_warnings",
    "duplicate_keys",
    "duplicate_members",
    "first_per_code",
    "first_wins",
    "key_counts",
    "last_wins",
    "latest_wins",
    "pick_one",
]
