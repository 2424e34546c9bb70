"""Problem 8: mixing sources to target weights.

Efraimidis-Spirakis sampling: each document draws the exponential key -ln(u)/w (u from a hash of its
id and a seed, w its quality weight); the documents with the smallest keys are a weighted sample
without replacement. A source's budget is its target share of the total size. Complete epochs are
used first (every document that many times), the fraction that remains is filled in key order by
prefix sums of tokens. No source exceeds ``max_repeats`` epochs.

Prefix sums are two-level: keys fall into buckets that partition a source's key order; tokens are
summed per (source, bucket), the bucket offsets are cumulated over that bounded table, and only within the
bucket that the budget cuts are rows ordered. So a source with a third of all rows is never
ordered in one task. Buckets are cut by the keys' own distribution: with a share p_j of weights w_j (in LEVELS steps)
a key is below t with probability 1 - sum of p_j exp(-w_j t), so buckets hold about equally many documents whatever the
weights, and there is one for every PER_BUCKET documents. The texts are read once.

Defined results: sources agree up to case and any character that is no letter or digit; documents of a null
or unlisted source and null texts take no part; a source without documents has size 0; a null
target share counts as 0 and a null ``max_repeats`` as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import cut
from .packing import byte_tokens

PER_BUCKET, LEVELS = 16384, 16


def source_key(source: Column) -> Column:
    """A source's comparison form: lower case letters and digits only."""
    return F.nullif(F.lower(F.regexp_replace(source, r"[^\p{L}\p{N}]", "")), F.lit(""))


def quality(text: Column) -> Column:
    """Quality weight in (0, 1]: the share of the text's characters that is not blacked out."""
    length = F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.05), 1 - (F.length(text) - F.length(F.replace(text, F.lit("█"), F.lit("")))) / length)


def listed_documents(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``(doc_id, skey, size, weight)`` of the documents whose source is in ``targets``.

    The targets are one row a source; the join is left to the planner, which broadcasts it by size.
    """
    keys = targets.select(source_key(F.col("source")).alias("skey")).where("skey IS NOT NULL").distinct()
    return (
        docs.where("text IS NOT NULL")
        .select("doc_id", source_key(F.col("source")).alias("skey"), byte_tokens(F.col("text")).alias("size"), quality(F.col("text")).alias("weight"))
        .join(keys, "skey")
    )


def budgets(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``budgets_of`` the listed documents."""
    return budgets_of(listed_documents(docs, targets), targets)


def budgets_of(listed: DataFrame, targets: DataFrame) -> DataFrame:
    """One row a target source, from ``listed_documents``: ``source, skey, target_share, max_repeats, size, total, budget, capped, epochs, rest``.

    ``capped`` marks a source that cannot reach its share: ``max_repeats * size < target_share * total``.
    ``epochs`` complete passes and ``rest`` tokens of a further one make up what is used.
    """
    sizes = listed.groupBy("skey").agg(F.sum("size").alias("size"))
    t = targets.select("source", source_key(F.col("source")).alias("skey"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"))
    spark = listed.sparkSession
    joined = t.join(sizes, "skey", "left").withColumn("size", F.coalesce("size", F.lit(0).cast("long")))
    total = spark.sql("SELECT *, (SELECT coalesce(sum(size), 0) FROM {sizes}) AS total FROM {joined}", sizes=sizes, joined=joined)
    want = F.col("target_share") * F.col("total")
    most = F.col("max_repeats") * F.col("size")
    return (
        total.withColumn("budget", want)
        .withColumn("capped", most < want)
        .withColumn("use", F.least(want, most.cast("double")))
        .withColumn("epochs", F.when(F.col("size") > 0, F.floor(F.col("use") / F.col("size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("use") - F.col("epochs") * F.col("size"))
    )


def mix(docs: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """``(doc_id, source, size, repeats)``: how often each document is used (0 times: no row)."""
    listed = cut(listed_documents(docs, targets))
    return mixed(listed, cut(budgets_of(listed, targets)), seed)


def mixed(listed: DataFrame, plan: DataFrame, seed: int = 17) -> DataFrame:
    """The mix out of ``listed_documents`` and their ``budgets``.

    Of the fractional epoch those documents are taken, in key order, whose tokens end within the rest.
    """
    plan = plan.select("skey", "source", "max_repeats", "epochs", "rest")
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)) + 1).cast("double") / float((1 << 52) + 1)
    levels = listed.groupBy("skey", F.ceil(F.col("weight") * LEVELS).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    shares = levels.groupBy("skey").agg(F.collect_list(F.struct("level", "n")).alias("levels"), F.sum("n").alias("docs"))
    beyond = F.aggregate("levels", F.lit(0.0), lambda acc, v: acc + v["n"] / F.col("docs") * F.exp(-F.col("key") * v["level"] / LEVELS))
    buckets = F.greatest(F.lit(1), F.ceil(F.col("docs") / PER_BUCKET))
    rows = (
        listed.join(shares, "skey")
        .withColumn("key", -F.log(u) / F.col("weight"))
        .withColumn("bucket", F.least(buckets - 1, F.floor(buckets * (1 - beyond))).cast("int"))
        .drop("levels", "docs")
    )
    upto = W.partitionBy("skey").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        rows.groupBy("skey", "bucket").agg(F.sum("size").alias("tokens"))
        .withColumn("before", F.coalesce(F.sum("tokens").over(upto), F.lit(0)))
        .join(plan, "skey")
        .withColumn("side", F.when(F.col("before") + F.col("tokens") <= F.col("rest"), 1).when(F.col("before") >= F.col("rest"), 0).otherwise(-1))
        .select("skey", "source", "bucket", "before", "epochs", "rest", "side")
    )
    marked = rows.join(starts, ["skey", "bucket"])
    whole = marked.where("side >= 0").select("doc_id", "source", "size", (F.col("epochs") + F.col("side")).alias("repeats"))
    run = W.partitionBy("skey", "bucket").orderBy("key", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    edge = marked.where("side < 0").withColumn("upto", F.col("before") + F.sum("size").over(run))
    last = edge.select("doc_id", "source", "size", (F.col("epochs") + (F.col("upto") <= F.col("rest")).cast("long")).alias("repeats"))
    return whole.unionByName(last).where("repeats > 0")


def share_report(docs: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """Per target source: the share wanted, the share reached in the mix, the tokens used and whether the cap binds."""
    listed = cut(listed_documents(docs, targets))
    plan = cut(budgets_of(listed, targets))
    used = mixed(listed, plan, seed).groupBy("source").agg(F.sum(F.col("size") * F.col("repeats")).alias("used"), F.max("repeats").alias("most_repeats"))
    rows = plan.join(used, "source", "left").withColumn("used", F.coalesce("used", F.lit(0).cast("long")))
    return docs.sparkSession.sql(
        "SELECT source, target_share, used / nullif((SELECT sum(used) FROM {rows}), 0) AS reached_share, used / nullif(total, 0) AS share_of_total, used, budget, size, max_repeats, coalesce(most_repeats, 0) AS most_repeats, capped FROM {rows}",
        rows=rows,
    )


def capped_sources(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source)`` of the targets whose share the mix did not reach although all it holds was used ``max_repeats`` times."""
    report = share_report(docs, targets)
    return report.where((F.col("used") == F.col("max_repeats") * F.col("size")) & (F.col("used") < F.col("budget"))).select("source")
