"""Statistics of clusters and of how domains fall into them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import euclidean


def _real(labels: DataFrame) -> DataFrame:
    return labels.filter("cluster_id <> -1").groupBy("cluster_id").agg(F.count("*").alias("size"))


def cluster_statistics(labels: DataFrame) -> DataFrame:
    """One row: clusters, noise and its share, sizes with population variance, balance, coverage."""
    totals = labels.agg(F.count("*").alias("records"), F.coalesce(F.sum((F.col("cluster_id") == -1).cast("long")), F.lit(0)).alias("noise"))
    sizes = _real(labels).agg(F.count("*").alias("clusters"), F.avg("size").alias("avg_size"), F.max("size").alias("max_size"), F.min("size").alias("min_size"), F.var_pop("size").alias("size_variance"))
    both = totals.crossJoin(sizes)
    return both.select(
        "*",
        F.try_divide(F.col("noise"), F.col("records")).alias("noise_ratio"),
        (1 / (1 + F.col("size_variance") / (F.col("avg_size") + 1e-8))).alias("balance"),
        F.try_divide(F.col("records") - F.col("noise"), F.col("records")).alias("coverage"),
    )


def size_distribution(labels: DataFrame) -> DataFrame:
    """One row: clusters by size class, percentiles of sizes and the kind of distribution."""
    size = F.col("size")
    share = lambda c: F.sum(c.cast("long"))
    row = _real(labels).agg(
        F.count("*").alias("clusters"),
        *[F.coalesce(share(size.between(a, b)), F.lit(0)).alias(n) for n, a, b in (("tiny", 2, 5), ("small", 6, 20), ("medium", 21, 100), ("large", 101, 1000))],
        F.coalesce(share(size > 1000), F.lit(0)).alias("huge"),
        *[F.percentile("size", F.lit(q / 100)).alias(f"p{q}") for q in (25, 50, 75, 90, 95)],
    )
    kind = (
        F.when(F.col("clusters") == 0, "empty").when(F.col("clusters") == 1, "single_cluster").when(F.col("huge") > 0, "skewed_large").when(F.col("tiny") > 0.8 * F.col("clusters"), "mostly_tiny").otherwise("mixed")
    )
    return row.withColumn("kind", kind)


def top_clusters(labels: DataFrame, domain: str = "domain_clean", n: int = 10) -> DataFrame:
    """The n largest clusters with their number of distinct domains."""
    return labels.filter("cluster_id <> -1").groupBy("cluster_id").agg(F.count("*").alias("size"), F.countDistinct(domain).alias("domains")).orderBy(F.desc("size"), "cluster_id").limit(n)


def subdivision_candidates(labels: DataFrame, domain: str = "domain_clean", size: int = 5) -> DataFrame:
    """Clusters of several domains and more than ``size`` records."""
    found = labels.filter("cluster_id <> -1").groupBy("cluster_id").agg(F.count("*").alias("size"), F.countDistinct(domain).alias("domains"))
    return found.filter((F.col("domains") > 1) & (F.col("size") > size))


def purity(labels: DataFrame, domain: str = "domain_clean") -> DataFrame:
    """One row: clusters, those of one domain, their share, and clusters by size class."""
    each = labels.filter("cluster_id <> -1").groupBy("cluster_id").agg(F.count("*").alias("size"), F.countDistinct(domain).alias("domains"))
    total = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    row = each.agg(F.count("*").alias("clusters"), total(F.col("domains") == 1).alias("pure"), total(F.col("size") == 1).alias("singletons"), total(F.col("size").between(2, 5)).alias("size_2_5"), total(F.col("size").between(6, 10)).alias("size_6_10"), total(F.col("size") > 10).alias("size_11_up"))
    return row.withColumn("purity", F.try_divide(F.col("pure"), F.col("clusters")))


def domain_scatter(labels: DataFrame, domain: str = "domain_clean") -> DataFrame:
    """domain, records, clusters (noise aside), kind: perfect in one cluster, scattered over several, unclustered."""
    n = F.countDistinct(F.when(F.col("cluster_id") != -1, F.col("cluster_id")))
    rows = labels.filter(F.nullif(F.col(domain), F.lit("")).isNotNull()).groupBy(F.col(domain).alias("domain")).agg(F.count("*").alias("records"), n.alias("clusters"))
    return rows.withColumn("kind", F.when(F.col("clusters") == 1, "perfect").when(F.col("clusters") > 1, "scattered").otherwise("unclustered"))


def scatter_summary(labels: DataFrame, domain: str = "domain_clean") -> DataFrame:
    """One row: domains by kind and the share of perfect ones."""
    of = lambda k: F.sum((F.col("kind") == k).cast("long")).alias(k)
    return domain_scatter(labels, domain).agg(F.count("*").alias("domains"), of("perfect"), of("scattered"), of("unclustered")).withColumn("rate", F.try_divide(F.col("perfect"), F.col("domains")))


def domain_spread(labels: DataFrame, domain: str = "domain_clean") -> DataFrame:
    """Domains of several records: how many cluster ids, noise counted, and how far apart the ids are."""
    rows = labels.filter(F.nullif(F.col(domain), F.lit("")).isNotNull()).groupBy(F.col(domain).alias("domain")).agg(F.count("*").alias("records"), F.countDistinct("cluster_id").alias("ids"), (F.max("cluster_id") - F.min("cluster_id")).alias("spread"))
    return rows.filter("records > 1")


def rescue_noise(labels: DataFrame, scored: DataFrame, domain: str = "domain_clean", least: float = 0.85) -> DataFrame:
    """record_id, cluster_id: noise records join the cluster of the record of their domain with the greatest domain_sim.

    Only records that were clustered before count; ties go to the first in row order.
    """
    ends = scored.select(F.col("record_id_1").alias("record_id"), F.col("record_id_2").alias("other"), "domain_sim")
    edges = ends.unionByName(scored.select(F.col("record_id_2").alias("record_id"), F.col("record_id_1").alias("other"), "domain_sim")).filter(F.col("domain_sim") >= least)
    noise = labels.filter("cluster_id = -1").filter(F.nullif(F.col(domain), F.lit("")).isNotNull()).select("record_id", F.col(domain).alias("own"))
    placed = labels.filter("cluster_id <> -1").select(F.col("record_id").alias("other"), F.col(domain).alias("theirs"), F.col("row_idx").alias("at"), F.col("cluster_id").alias("to"))
    found = edges.join(noise, "record_id").join(placed, "other").filter("own = theirs")
    best = found.groupBy("record_id").agg(F.min(F.struct((-F.col("domain_sim")).alias("less"), "at", "to")).alias("best"))
    return labels.select("record_id", "cluster_id").join(best, "record_id", "left").select("record_id", F.coalesce("best.to", "cluster_id").alias("cluster_id"))


def value_distribution(scored: DataFrame, column: str = "domain_sim") -> DataFrame:
    """One row: count, minimum, maximum, mean, median and how many values pass some marks, those of weighed values among them."""
    c = F.col(column)
    over = lambda x, name, strict=True: F.sum(((c > x) if strict else (c >= x)).cast("long")).alias(name)
    return scored.agg(F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high"), F.avg(c).alias("mean"), F.percentile(column, F.lit(0.5)).alias("median"), F.sum((c == 0).cast("long")).alias("zero"), over(0, "positive"), over(0.8, "over_80"), over(0.9, "over_90"), over(0.95, "over_95"), over(0.6, "from_60", False), over(100, "over_100"), over(1000, "over_1000"))


def describe(table: DataFrame, columns: list[str]) -> DataFrame:
    """feature, count, mean, std (sample), min, quartiles, max, nonzero: a row for each column. Quartiles are exact (linear)."""
    parts = {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, **{f"p{q}": (lambda c, q=q: F.percentile(c, F.lit(q / 100))) for q in (25, 50, 75)},
        "max": F.max, "nonzero": lambda c: F.coalesce(F.sum((F.col(c) != 0).cast("long")), F.lit(0)),
    }
    once = table.agg(*[f(c).alias(f"{c}__{k}") for c in columns for k, f in parts.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"`{c}__{k}`").alias(k) for k in parts]) for c in columns])
    return once.select(F.explode(rows).alias("r")).select("r.*")


def distance_statistics(points: DataFrame, group: str = "group", key: str = "node", vector: str = "x") -> DataFrame:
    """group, pairs, low, high, mean and the percentiles of distances within a group that suggest radii.

    All pairs of a group meet: for the members of one cluster or a sample.
    """
    a = points.select(group, F.col(key).alias("a"), F.col(vector).alias("x"))
    b = points.select(group, F.col(key).alias("b"), F.col(vector).alias("y"))
    met = a.join(b, group).filter("a < b").withColumn("d", euclidean(F.col("x"), F.col("y")))
    marks = [F.percentile("d", F.lit(q / 100)).alias(f"p{q}") for q in (10, 25, 50, 75, 90)]
    return met.groupBy(group).agg(F.count("*").alias("pairs"), F.min("d").alias("low"), F.max("d").alias("high"), F.avg("d").alias("mean"), *marks)


def flat_statistics(labels: DataFrame, silhouette: DataFrame | None = None, **parameters) -> DataFrame:
    """One row for the run log: the parameters of a clustering, clusters, noise, silhouette (0.0 if none is given)."""
    row = labels.agg(F.countDistinct(F.when(F.col("cluster_id") != -1, F.col("cluster_id"))).alias("n_clusters"), F.coalesce(F.sum((F.col("cluster_id") == -1).cast("long")), F.lit(0)).alias("n_noise"))
    score = row.sparkSession.range(1).select(F.lit(0.0).alias("silhouette_score")) if silhouette is None else silhouette.select(F.col("silhouette").alias("silhouette_score"))
    return row.crossJoin(score).select(*[F.lit(v).alias(k) for k, v in parameters.items()], "*")


def most_frequent(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return df.groupBy(column).count().orderBy(F.desc("count"), column).limit(n)


def match_rate(cleaned: DataFrame, raw: str, clean: str = "domain_clean") -> DataFrame:
    return cleaned.agg(F.count("*").alias("records"), F.avg((F.coalesce(raw, F.lit("")) == F.coalesce(clean, F.lit(""))).cast("double")).alias("rate"))


def pair_coverage(ids: list[str], pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """record_id, in how many pairs with the others it is, and its cluster."""
    some = labels.filter(F.col("record_id").isin(ids)).select("record_id", "cluster_id")
    inside = pairs.filter(F.col("record_id_1").isin(ids) & F.col("record_id_2").isin(ids))
    ends = inside.select(F.explode(F.array("record_id_1", "record_id_2")).alias("record_id")).groupBy("record_id").agg(F.count("*").alias("pairs"))
    return some.join(ends, "record_id", "left").na.fill(0, ["pairs"])


def cluster_detail(labels: DataFrame, cluster: int, domain: str = "domain_clean", samples: int = 3, domains: int = 5) -> DataFrame:
    """The first records of a cluster's most frequent domains, with the domain's count."""
    rows = labels.filter(F.col("cluster_id") == cluster)
    top = rows.groupBy(domain).agg(F.count("*").alias("records")).orderBy(F.desc("records"), domain).limit(domains)
    nth: Column = F.row_number().over(Window.partitionBy(domain).orderBy("row_idx"))
    return rows.join(F.broadcast(top), domain).withColumn("nth", nth).filter(F.col("nth") <= samples)


def pairs_of_cluster(pairs: DataFrame, labels: DataFrame, cluster: int) -> DataFrame:
    """Pairs with an end in the cluster."""
    some = labels.filter(F.col("cluster_id") == cluster).select("record_id")
    ends = pairs.withColumn("end", F.explode(F.array("record_id_1", "record_id_2"))).join(some, F.col("end") == some["record_id"], "left_semi")
    return ends.drop("end").distinct()
