"""Customer features, rule segments, engagement bands and K-means clustering.

Customer features are one ``groupBy(customer_id)`` of the columns they need: a customer's
few rows meet in a task and are aggregated there, while a customer of very many journeys
is combined map-side. Distinct counts per customer use ``size(collect_set(..))`` whose sets
are bounded by the vocabulary (modes, regions) or by the selected date range
(active days), so no Expand x(n+1) of the fact rows is needed. K-means runs
over the (cached) one-row-per-customer matrix, all fits at once (``clustering``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions.metrics import np_round, share
from ..functions.selection import exact_quantiles
from ..plans.filters import Selection
from . import clustering
from .kpis import _where

SHARE_FLAGS = {
    "complaint_rate": "complaint_flag",
    "peak_share": "is_peak",
    "digital_share": "digital_interaction",
    "accessibility_share": "accessibility_service_used",
}
FEATURE_INPUTS = ("date", "transport_mode", "region", "delay_minutes", "customer_satisfaction",
                  *SHARE_FLAGS.values(), "on_time", "customer_segment", "age_group", "channel")

# Customers of more journeys than this are combined map-side.
MANY_JOURNEYS = 100_000


def _per_customer(rows: DataFrame, aggregates: Sequence[Column]) -> DataFrame:
    """``rows`` aggregated by ``customer_id``. Sets and counts of a customer whose journeys lie in many
    tasks are wider than the journeys, so these move as they are and are aggregated where they meet.
    The rows of a customer of more than MANY_JOURNEYS shrink to one per map task before they move."""
    hashed = rows.withColumn("_h", F.xxhash64("customer_id"))
    # at most one hash per MANY_JOURNEYS rows: a proven broadcast bound
    many = F.broadcast(hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("n"))
                       .where(F.col("n") > MANY_JOURNEYS).select("_h"))
    few = hashed.join(many, "_h", "left_anti").drop("_h").repartition("customer_id")
    much = hashed.join(many, "_h", "left_semi").drop("_h")
    return (few.groupBy("customer_id").agg(*aggregates)
            .unionByName(much.groupBy("customer_id").agg(*aggregates)))


def customer_features(analytics: DataFrame, filters: Selection | None,
                      min_journeys: int = 3) -> DataFrame:
    """A8 + A9: one row per customer (>= min journeys, NULL id dropped)."""
    n = F.count(F.lit(1))
    # shares divide by all journeys (a NULL flag counts as "no"), unlike the
    # null-aware registry rates; on-time performance stays null-aware
    shares = [share(flag).alias(k) for k, flag in SHARE_FLAGS.items()]
    otp = (F.lit(100.0) * F.count(F.when(F.col("on_time"), 1))
           / F.nullif(F.count("on_time"), F.lit(0)))
    rows = (_where(analytics, filters).where(F.col("customer_id").isNotNull())
            .select("customer_id", *FEATURE_INPUTS))
    g = _per_customer(rows, [
        n.alias("journeys"),
        F.size(F.collect_set("date")).cast("bigint").alias("active_days"),
        F.size(F.collect_set("transport_mode")).cast("bigint").alias("modes_used"),
        F.size(F.collect_set("region")).cast("bigint").alias("regions_used"),
        F.avg("delay_minutes").alias("avg_delay_minutes"),
        F.avg("customer_satisfaction").alias("avg_satisfaction"),
        *shares,
        otp.alias("on_time_performance"),
        F.min("date").alias("first_journey"),
        F.max("date").alias("last_journey"),
        F.min("customer_segment").alias("assigned_segment"),
        F.min("age_group").alias("age_group"),
        F.mode("channel", deterministic=True).alias("primary_channel"),
        F.mode("transport_mode", deterministic=True).alias("primary_mode"),
    ]).where(F.col("journeys") >= min_journeys)
    span = F.greatest(F.datediff("last_journey", "first_journey"), F.lit(6)) + 1
    return g.select(
        "customer_id", "journeys", "active_days", "modes_used", "regions_used",
        np_round("avg_delay_minutes", 2).alias("avg_delay_minutes"),
        np_round("avg_satisfaction", 2).alias("avg_satisfaction"),
        *[np_round(k, 1).alias(k) for k in SHARE_FLAGS],
        np_round("on_time_performance", 1).alias("on_time_performance"),
        "first_journey", "last_journey", "assigned_segment", "age_group",
        "primary_channel", "primary_mode",
        np_round(F.col("journeys") / span * 7, 2).alias("journeys_per_week"))


def rule_segment_column() -> Column:
    """G1: first matching rule wins, evaluated on the rounded features."""
    t = C.RULE_THRESHOLDS
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    jpw = F.col("journeys_per_week")
    high_need = ((z("accessibility_share") >= t["high_need_accessibility_share"])
                 | (z("complaint_rate") >= t["high_need_complaint_rate"]))
    frequent = (jpw >= t["frequent_journeys_per_week"]) & (z("peak_share") >= t["frequent_peak_share"])
    digital = z("digital_share") >= t["digital_first_share"]
    regular = (jpw >= t["regular_journeys_per_week"]) & (z("peak_share") < t["regular_peak_share"])
    return (F.when(high_need, "High-Service-Need Customers")
            .when(frequent, "Frequent Commuters")
            .when(digital, "Digital-First Customers")
            .when(regular, "Off-Peak Regulars")
            .otherwise("Occasional Travellers"))


def rule_segments(features: DataFrame) -> DataFrame:
    return features.select("*", rule_segment_column().alias("rule_segment"))


def segment_profile(labelled: DataFrame, label: str,
                    feature_columns: Sequence[str] = C.CLUSTER_FEATURES) -> DataFrame:
    """Size, mean features (2 dp) and share of customers (1 dp) per segment."""
    g = labelled.groupBy(F.col(label).alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"),
        *[np_round(F.avg(c), 2).alias(c) for c in feature_columns])
    total = F.sum("customers").over(Window.partitionBy())   # <= k / 5 grouped rows
    return g.select("*", np_round(F.col("customers") / total * 100, 1).alias("share_pct"))


def engagement_bands(features: DataFrame) -> DataFrame:
    """Customers and mean satisfaction (6 dp) per journeys/week band
    (right-closed bins); empty bands are kept. One pass of band-gated aggregates."""
    jpw = F.col("journeys_per_week")
    aggs = []
    for i, (_, lo, hi) in enumerate(C.ENGAGEMENT_BANDS):
        inside = (jpw > lo) & (jpw <= hi)
        aggs += [F.count(F.when(inside, 1)).alias(f"n{i}"),
                 np_round(F.avg(F.when(inside, F.col("avg_satisfaction"))), 6).alias(f"s{i}")]
    stack = ", ".join(f"'{name}', {i}, n{i}, s{i}"
                      for i, (name, _, _) in enumerate(C.ENGAGEMENT_BANDS))
    return features.agg(*aggs).select(F.expr(
        f"stack({len(C.ENGAGEMENT_BANDS)}, {stack}) AS (band, position, customers, satisfaction)"))


def frequency_histogram(features: DataFrame, bins: int = 40) -> DataFrame:
    """journeys/week clipped at its 99th percentile, in ``bins`` equal-width
    bins between the minimum and the clip value, empty bins included. All customers
    alike: one bin without width; no customers: no bins."""
    features = features.checkpoint(eager=True)      # read by every round of the selection
    b = (exact_quantiles(features, {"hi": ("journeys_per_week", 0.99), "lo": ("journeys_per_week", 0.0)})
         .select(F.struct("hi", "lo")).scalar())
    clipped = F.least(F.col("journeys_per_week"), b["hi"])
    span = b["hi"] - b["lo"]
    idx = F.when(span > 0, F.least(F.floor((clipped - b["lo"]) / span * bins), F.lit(bins - 1))) \
        .otherwise(F.lit(0)).cast("int")
    width = span / float(bins)
    g = features.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("customers"))
    every = (features.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
             .where((span > 0) | (b["lo"].isNotNull() & (F.col("bin") == 0))))
    return (every.join(g, "bin", "left")
            .select("bin", (b["lo"] + F.col("bin") * width).alias("bin_start"),
                    (b["lo"] + (F.col("bin") + 1) * width).alias("bin_end"),
                    F.coalesce("customers", F.lit(0)).alias("customers")))


def top_customers(features: DataFrame, n: int = 200) -> DataFrame:
    """The most active customers (journeys desc, id asc)."""
    cols = ["customer_id", "assigned_segment", "age_group", "journeys", "journeys_per_week",
            "avg_satisfaction", "complaint_rate", "peak_share", "digital_share",
            "primary_mode", "primary_channel"]
    return features.orderBy(F.col("journeys").desc(), F.col("customer_id")).limit(n).select(*cols)


# ---------------------------------------------------------------------------
# Standardised matrix and K-means
# ---------------------------------------------------------------------------

def standardised_features(features: DataFrame,
                          feature_columns: Sequence[str] = C.CLUSTER_FEATURES,
                          digits: int | None = 6) -> DataFrame:
    """Median-fill each feature, then (x - mean) / population sigma (a zero
    sigma leaves x - mean). Medians and moments are scalar subqueries."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(features.sparkSession)
    # three passes read the features (medians, moments, projection): cut the
    # lineage once so journeys are aggregated a single time
    features = features.checkpoint(eager=True)
    cols = list(feature_columns)
    med = exact_quantiles(features, {c: (c, 0.5) for c in cols}).select(F.struct(*cols)).scalar()
    filled = features.select("customer_id", *[
        F.coalesce(F.col(c).cast("double"), med[c]).alias(c) for c in cols])
    mom = filled.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in cols],
                              *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])).scalar()
    out = []
    for c in cols:
        centred = F.col(c) - mom[f"m_{c}"]
        z = F.when(mom[f"s_{c}"] > 0, centred / mom[f"s_{c}"]).otherwise(centred)
        out.append((np_round(z, digits) if digits is not None else z).alias(c))
    return filled.select("customer_id", *out)


# Rows per partition of the K-means matrix (seven doubles per customer).
MATRIX_ROWS_PER_PARTITION = 250_000


def kmeans_matrix(features: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, int]:
    """The standardised features (6 dp), checkpointed in the shared folder and sized to about
    250k rows per partition, so that every K-means step reads a compact input."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(features.sparkSession)
    matrix = standardised_features(features, cols).checkpoint(eager=True)
    n = matrix.count()
    parts = max(1, min(matrix.rdd.getNumPartitions(), -(-n // MATRIX_ROWS_PER_PARTITION)))
    return matrix.coalesce(parts).persist(), n


def cluster_customers(features: DataFrame, k: int = 4, n_init: int = 10,
                      feature_columns: Sequence[str] = C.CLUSTER_FEATURES) -> DataFrame:
    """G4 + G7: customers with a cluster id and a readable cluster label.

    The fit of the lowest inertia among ``n_init`` restarts; cluster ids follow the centres'
    coordinates. Fewer customers than k: no clusters (empty result).
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(features.sparkSession)
    # the matrix, the labels and the result read the features: journeys are aggregated once
    features = features.checkpoint(eager=True)
    cols = list(feature_columns)
    matrix, n = kmeans_matrix(features, cols)
    if n < k:
        return features.select("*", F.lit(None).cast("int").alias("cluster"),
                               F.lit(None).cast("string").alias("cluster_label")).limit(0)
    centres = clustering.fit(matrix, cols, [k], restarts=n_init)[k].centres
    assigned = matrix.select("customer_id", clustering.nearest(cols, centres).alias("cluster"))
    labelled = features.join(assigned, "customer_id")
    labels = cluster_labels(labelled, cols)
    # k rows: a proven broadcast bound.
    return labelled.join(F.broadcast(labels), "cluster")


def cluster_labels(labelled: DataFrame, cols: Sequence[str]) -> DataFrame:
    """name = the two features whose centroid is furthest from the mean of
    centroids (in centroid-sd units), phrased high/low; repeated names get
    " (id+1)"; none -> "Mixed profile". Runs on a k x features table."""
    centroids = labelled.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', {i}, CAST(`{c}` AS DOUBLE)" for i, c in enumerate(cols))
    long = centroids.select("cluster", F.expr(
        f"stack({len(cols)}, {stack}) AS (feature, feature_pos, value)"))
    per_feature = Window.partitionBy("feature")
    sd = F.stddev_pop("value").over(per_feature)
    z = (F.col("value") - F.avg("value").over(per_feature)) / F.when(sd != 0, sd)
    scored = long.select("*", z.alias("z"))
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(
        F.abs(F.col("z")).desc_nulls_last(), F.col("feature_pos")))
    phrases_hi = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(C.CLUSTER_PHRASES[c][0]))])
    phrases_lo = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(C.CLUSTER_PHRASES[c][1]))])
    phrase = F.when(F.col("z").isNull(), F.lit(None)).when(
        F.col("z") > 0, phrases_hi[F.col("feature")]).otherwise(phrases_lo[F.col("feature")])
    top = scored.select("*", rank.alias("rk"), phrase.alias("phrase")).where(F.col("rk") <= 2)
    named = top.groupBy("cluster").agg(
        F.concat_ws(" ", F.sort_array(F.collect_list(F.struct("rk", "phrase")))
                    .getField("phrase")).alias("raw"))
    base = F.when(F.col("raw") == "", F.lit("Mixed profile")).otherwise(F.col("raw"))
    name = F.concat(F.upper(F.substring(base, 1, 1)), F.substring(base, 2, 10_000),
                    F.lit(" customers"))
    dup = F.row_number().over(Window.partitionBy("name").orderBy("cluster"))
    return (named.select("cluster", name.alias("name"))
            .select("cluster", F.when(dup > 1, F.concat(F.col("name"), F.lit(" ("),
                                                       (F.col("cluster") + 1).cast("string"),
                                                       F.lit(")")))
                    .otherwise(F.col("name")).alias("cluster_label")))


def _sample(matrix: DataFrame, n: int = C.SILHOUETTE_SAMPLE) -> DataFrame:
    """The matrix rows of ``customer_sample``."""
    return matrix.orderBy(F.md5("customer_id"), "customer_id").limit(n)


def silhouette(features: DataFrame, k: int = 4, n_init: int = 10,
               feature_columns: Sequence[str] = C.CLUSTER_FEATURES) -> DataFrame:
    """(k, silhouette): the exact Euclidean silhouette (6 dp) of the best K-means fit over the
    ``customer_sample``; NULL unless there are more customers than k."""
    cols = list(feature_columns)
    matrix, n = kmeans_matrix(features, cols)
    if n <= k:
        return features.sparkSession.createDataFrame([(k, None)], "k INT, silhouette DOUBLE")
    fits = clustering.fit(matrix, cols, [k], restarts=n_init)
    return (clustering.silhouettes(_sample(matrix), cols, fits)
            .withColumn("silhouette", np_round("silhouette", 6)))


def inertia_curve(features: DataFrame, k_values: Sequence[int] = (2, 3, 4, 5, 6, 7, 8),
                  n_init: int = 10, feature_columns: Sequence[str] = C.CLUSTER_FEATURES) -> DataFrame:
    """(k, inertia, silhouette) for each k, all fits in one scan per step; empty with
    fewer than max(k)+1 rows."""
    cols = list(feature_columns)
    matrix, n = kmeans_matrix(features, cols)
    if n < max(k_values) + 1:
        return features.sparkSession.createDataFrame([], "k INT, inertia DOUBLE, silhouette DOUBLE")
    fits = clustering.fit(matrix, cols, list(k_values), restarts=n_init)
    return clustering.elbow(fits, clustering.silhouettes(_sample(matrix), cols, fits))


def fit_check(features: DataFrame, k: int = 4, n_init: int = 10,
              feature_columns: Sequence[str] = C.CLUSTER_FEATURES,
              tolerance: float = 1e-2) -> DataFrame:
    """G4 checked from its definition, one row: k, customers, clusters in use, customers
    nearer to another centre than to their own, whether every centre is the mean of its
    customers (each coordinate within ``tolerance``) and whether the training cost is the
    sum of their squared distances (relative 1e-6). Fewer customers than k: no row."""
    cols = list(feature_columns)
    matrix, n = kmeans_matrix(features, cols)
    if n < k:
        return features.sparkSession.createDataFrame([], (
            "k INT, customers LONG, clusters LONG, misplaced LONG, centres_settled BOOLEAN, "
            "cost_agrees BOOLEAN"))
    best = clustering.fit(matrix, cols, [k], restarts=n_init)[k]
    cost, centres = best.inertia, best.centres.tolist()
    placed = matrix.select(clustering.nearest(cols, best.centres).alias("cluster"), F.array(*cols).alias("x"))

    def distance(centre: list[float]) -> Column:
        return sum(((F.col("x")[i] - F.lit(v)) ** 2 for i, v in enumerate(centre)), F.lit(0.0))

    away = placed.select("cluster", "x", F.array(*[distance(c) for c in centres]).alias("d"))
    own = F.col("d")[F.col("cluster")]
    dims = range(len(centres[0]))
    groups = away.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(own > F.array_min("d") + 1e-9).alias("misplaced"), F.sum(own).alias("cost"),
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in dims])
    fixed = F.array(*[F.array(*[F.lit(v) for v in c]) for c in centres])[F.col("cluster")]
    drift = F.greatest(*[F.abs(F.col(f"m{i}") - fixed[i]) for i in dims])
    return groups.agg(
        F.sum("customers").alias("customers"), F.count(F.lit(1)).alias("clusters"),
        F.sum("misplaced").alias("misplaced"), F.max(drift).alias("drift"),
        F.sum("cost").alias("cost")).select(
        F.lit(k).alias("k"), "customers", "clusters", "misplaced",
        (F.col("drift") <= tolerance).alias("centres_settled"),
        (F.abs(F.col("cost") - cost) <= 1e-6 * max(cost, 1.0)).alias("cost_agrees"))


def customer_sample(features: DataFrame, n: int = C.SILHOUETTE_SAMPLE) -> DataFrame:
    """A repeatable sample of at most ``n`` customers: the first ``n`` in
    md5(customer_id) order (pseudo-random, identical on every run and engine)."""
    return features.orderBy(F.md5("customer_id"), F.col("customer_id")).limit(n)


def cluster_rule_crosstab(clustered: DataFrame) -> DataFrame:
    """Clusters x rule segments, zero-filled (the 5 segments are fixed)."""
    labelled = clustered.select("cluster_label", rule_segment_column().alias("rule_segment"))
    return (labelled.groupBy("cluster_label").pivot("rule_segment", list(C.CUSTOMER_SEGMENTS))
            .count().fillna(0))
