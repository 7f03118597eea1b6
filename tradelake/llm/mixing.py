"""Mixing domains to target weights: soft membership, then rates by projected gradient.

Only DataFrame and SQL functions run on the rows; the driver sees matrices of domains by domains.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import packed, quoted, stored

#: Hashed words of the classifier; its table has a row for each.  A power of two.
BUCKETS = 1 << 13
#: Domains whose logs stand in one literal table: BUCKETS times as many numbers, 4 MB.
SLAB = 64
SMOOTHING = 0.5
STEPS, TOLERANCE, RESTATE = 40, 1e-4, 8


def _words(text_col: str) -> Column:
    """The words of a text, lower-cased, between blanks; none for a null text."""
    text = F.lower(quoted(text_col))
    for blank in ("\n", "\t", "\r"):
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.coalesce(F.array_remove(F.split(text, " "), ""), F.array().cast("array<string>"))


def _bucket(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


class Classifier:
    """Naive Bayes over hashed words; ``table`` has ``bucket`` and ``logs``, one a domain; ``prior`` logs."""

    def __init__(self, domains: list, table: DataFrame, prior: list[float]) -> None:
        self.domains, self.table, self.prior = domains, table, prior

    def slab(self, start: int) -> Column:
        """The logs of SLAB domains from ``start``, bucket after bucket, as one array: a scalar subquery,
        worked out once and sent with the tasks."""
        some = F.slice("logs", start + 1, SLAB)
        rows = F.sort_array(F.collect_list(F.struct("bucket", some.alias("l"))))
        return self.table.agg(F.flatten(F.transform(rows, lambda r: r["l"]))).scalar()


def fit_classifier(labelled: DataFrame, *, domain_col: str, text_col: str = "text") -> Classifier:
    """Counts words of all labelled rows by hash and domain, and turns them into log shares.

    Rows without a domain are left out; with none left the classifier knows no domain.  Domains are
    sorted as text.  The table holds BUCKETS numbers a domain (64 KB), so its size follows the number of
    domains alone.
    """
    known = labelled.where(quoted(domain_col).isNotNull())
    domain = quoted(domain_col).cast("string").alias("domain")
    totals = known.select(domain, F.size(_words(text_col)).alias("n")).groupBy("domain")
    totals = totals.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    rows = sorted(totals.collect(), key=lambda r: r.domain)
    words = known.select(domain, F.explode(_words(text_col)).alias("word"))
    counts = stored(words.groupBy("domain", _bucket(F.col("word")).alias("bucket")).agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    spark = labelled.sparkSession
    number = F.array_position(F.array(*(F.lit(r.domain) for r in rows)).cast("array<string>"), F.col("domain"))
    held = counts.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct(number.cast("int").alias("d"), "n"))).alias("n"))
    buckets = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    sizes = F.array(*(F.struct(F.lit(k + 1).alias("d"), F.lit(float(r.n)).alias("n")) for k, r in enumerate(rows)))
    share = lambda r: F.log((F.coalesce(F.col("n")[r["d"]], F.lit(0)) + SMOOTHING) / (r["n"] + SMOOTHING * BUCKETS))
    logs = F.transform(sizes, share) if rows else F.array().cast("array<double>")
    table = buckets.join(held, "bucket", "left").select("bucket", logs.alias("logs"))
    all_texts = sum(r.texts for r in rows)
    prior = [float(np.log(r.texts / all_texts)) for r in rows]
    return Classifier([r.domain for r in rows], stored(table, "mix-classifier"), prior)


def with_posteriors(rows: DataFrame, model: Classifier, words: str) -> DataFrame:
    """``rows`` with ``found``, struct ``tokens, p``, in place of the column ``words``.

    The words are hashed once and summed over in place, so that no row is made of a word.  The log
    likelihood is divided by the square root of the number of words, as words of a text are far from
    independent; this keeps memberships soft.  Texts without words get the priors.
    """
    size, zero = len(model.domains), F.lit(0.0)
    starts = list(range(0, size, SLAB))

    def adding(slab: Column, width: int, d: int):
        return lambda s, bucket: s + F.get(slab, bucket * width + d)

    def logs(buckets: Column, slabs: list[Column]) -> Column:
        if len(slabs) < len(starts):  # the next slab is bound by a lambda: each is named once
            return F.transform(F.array(f"_slab{len(slabs)}"), lambda t: logs(buckets, [*slabs, t]))[0]
        soft = F.greatest(F.sqrt(F.size(buckets)), F.lit(1.0))
        sums = [
            F.aggregate(buckets, zero, adding(slab, min(SLAB, size - start), d)) / soft + F.lit(model.prior[start + d])
            for start, slab in zip(starts, slabs, strict=True)
            for d in range(min(SLAB, size - start))
        ]
        return F.array(*sums).cast("array<double>")

    def of(buckets: Column) -> Column:
        return F.struct(F.size(buckets).cast("long").alias("tokens"), logs(buckets, []).alias("logs"))

    def powers(x: Column) -> Column:
        top = F.array_max(x["logs"])
        raised = F.transform(F.array(top), lambda t: F.transform(x["logs"], lambda y: F.exp(y - t)))[0]
        return F.struct(x["tokens"].alias("tokens"), raised.alias("e"))

    def shares(x: Column) -> Column:
        total = F.aggregate(x["e"], zero, lambda s, y: s + y)
        p = F.transform(F.array(total), lambda t: F.transform(x["e"], lambda y: y / t))[0]
        return F.struct(x["tokens"].alias("tokens"), p.alias("p"))

    # one-element arrays bind a value by a lambda, so that none is worked out twice
    found = F.array(F.transform(words, _bucket))
    for step in (of, powers, shares):
        found = F.transform(found, step)
    # subqueries can't be written inside these functions; the optimizer puts each where it is used once
    slabs = rows.select("*", *(model.slab(start).alias(f"_slab{k}") for k, start in enumerate(starts)))
    return slabs.select(*(c for c in rows.columns if c != words), found[0].alias("found"))


def memberships(docs: DataFrame, model: Classifier, *, text_col: str = "text") -> DataFrame:
    """All rows with ``tokens`` and posteriors ``p``; such columns of the input give way."""
    rows = docs.select(packed(docs, ["tokens", "p"]), _words(text_col).alias("_words"))
    return with_posteriors(rows, model, "_words").select("_row.*", "found.tokens", "found.p")


def gram_matrix(members: DataFrame, size: int) -> np.ndarray:
    """Sum over rows of tokens by the products of memberships: a row a domain reaches the driver."""
    p = [F.col("p")[d] for d in range(size)]
    each = members.select("tokens", "p", F.posexplode("p").alias("i", "x")).where("x > 0")
    rows = each.groupBy("i").agg(*(F.sum(F.col("tokens") * F.col("x") * y).alias(f"g{d}") for d, y in enumerate(p)))
    gram = np.zeros((size, size))
    for r in rows.collect():
        gram[r.i] = [r[f"g{d}"] or 0.0 for d in range(size)]
    return (gram + gram.T) / 2


def _inverse(a: np.ndarray) -> np.ndarray:
    """Of a positive definite matrix, by elimination; threaded libraries are left out of the driver."""
    size = len(a)
    both = np.concatenate((a, np.eye(size)), axis=1)
    for k in range(size):
        both[k] /= both[k, k]
        factors = both[:, k].copy()
        factors[k] = 0.0
        both -= np.multiply.outer(factors, both[k])
    return both[:, size:]


def fit_rates(members: DataFrame, targets: list[float]) -> tuple[DataFrame, list[float]]:
    """Nonnegative ``rate`` of each row so that expected tokens of the domains meet ``targets``.

    Projected gradient on the squared misfit of domain totals, from rate one for all.  The misfit is
    measured in the inverse of the Gram matrix of memberships (domains by domains, weighted by
    tokens); in that metric a step of length one never overshoots.  Each step is one aggregation to
    as many numbers as there are domains; steps end when totals meet the targets or no longer move.  Returns rows with rates, and the totals reached, which the
    caller compares with the targets: domains that no row belongs to can't be filled.
    """
    size = len(targets)
    rows = members.withColumn("rate", F.lit(1.0))
    gram = gram_matrix(members, size)
    scale = float(np.trace(gram))
    if not scale > 0:  # no tokens
        return rows, [0.0] * size
    inverse = _inverse(gram / scale + 1e-9 * np.eye(size)) / scale
    wanted = np.array(targets)
    totals, newton = _totals(rows, size), True
    for step in range(STEPS):
        if misfit(totals, wanted) <= TOLERANCE:
            break
        gap = wanted - totals
        # where the cut at zero spoils a step in that metric, plain ones follow, which never overshoot
        weights = (inverse * gap).sum(axis=1) if newton else gap / gram.sum(axis=1).max()
        pull = F.array(*(F.lit(float(x)) for x in weights))
        move = F.aggregate(F.zip_with("p", pull, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        tried = rows.withColumn("rate", F.greatest(F.lit(0.0), F.col("rate") + move))
        if step % RESTATE == RESTATE - 1:
            tried = stored(tried, "mix-rates")
        reached = _totals(tried, size)
        if newton and ((wanted - reached) ** 2).sum() >= (gap**2).sum():
            newton = False
            continue
        settled = np.abs(reached - totals).sum() <= TOLERANCE / 100 * wanted.sum()
        rows, totals = tried, reached
        if settled:
            break
    return rows, totals.tolist()


def _totals(rows: DataFrame, size: int) -> np.ndarray:
    """Expected tokens of each domain at the rows' rates."""
    each = rows.select((F.col("tokens") * F.col("rate")).alias("w"), F.posexplode("p").alias("i", "x"))
    totals = np.zeros(size)
    for r in each.groupBy("i").agg(F.sum(F.col("w") * F.col("x")).alias("t")).collect():
        totals[r.i] = r.t
    return totals


def misfit(totals: np.ndarray, wanted: np.ndarray) -> float:
    """Tokens in the wrong domain, as a share of all that are wanted."""
    return float(np.abs(wanted - totals).sum() / max(wanted.sum(), 1e-300))


def mix(
    docs: DataFrame,
    model: Classifier,
    weights: dict[str, float],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 7,
    with_text: bool = True,
) -> DataFrame:
    """All rows of ``docs`` with ``tokens``, ``domain`` (the likeliest), ``rate`` and ``copies``.

    ``weights`` are the shares of tokens asked of the domains; those not named get none, and the
    sum is scaled to the tokens of ``docs``, so that rates are one on average.  ``copies`` is the
    rate rounded up or down by a hash of id and text, the same in every run; its mean is the rate.
    Rows are written once with their memberships, without the text unless ``with_text``.  Where the
    totals reached miss the targets by more than TOLERANCE of the tokens, a warning names the share.

    Null and empty texts have no tokens and keep rate one; where no text has tokens all do.  A
    classifier without domains leaves all rates at one and the domain null.  Rows that repeat both id
    and text get the same rate.  Input columns with the names of new ones give way.  A weight below
    zero, or of a domain the classifier doesn't know, is refused; an empty table gives no rows.
    """
    if unknown := set(weights) - set(model.domains):
        raise ValueError(f"weights of unknown domains: {sorted(unknown)}")
    if min(weights.values(), default=0) < 0 or (model.domains and sum(weights.values()) <= 0):
        raise ValueError("weights must not be negative and some must be positive")
    own = ["tokens", "domain", "rate", "copies", *([] if with_text else [text_col])]
    draw = F.pmod(F.xxhash64(F.lit(seed), F.xxhash64(quoted(id_col), quoted(text_col))), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.select(packed(docs, own), draw.alias("draw"), _words(text_col).alias("_words"))
    members = with_posteriors(rows, model, "_words").select("_row", "draw", "found.tokens", "found.p")
    members = stored(members, "mix-members")
    if model.domains:
        total = members.agg(F.sum("tokens")).first()[0] or 0
        whole = sum(weights.values())
        targets = [weights.get(d, 0.0) / whole * total for d in model.domains]
        rates, reached = fit_rates(members, targets)
        if total and (missed := misfit(np.array(reached), np.array(targets))) > TOLERANCE:
            warnings.warn(f"{missed:.2%} of the tokens miss the target weights", stacklevel=2)
        names = F.array(*map(F.lit, model.domains))
        domain = F.element_at(names, F.array_position("p", F.array_max("p")).cast("int"))
    else:
        rates, domain = members.withColumn("rate", F.lit(1.0)), F.lit(None).cast("string")
    rates = rates.withColumn("rate", F.when(F.col("tokens") > 0, F.col("rate")).otherwise(1.0))
    copies = F.floor("rate") + F.when(F.col("draw") < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return rates.select("_row.*", "tokens", domain.alias("domain"), "rate", copies.cast("int").alias("copies"))
