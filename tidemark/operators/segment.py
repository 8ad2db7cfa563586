"""Regional features, clusters and a two-dimensional projection."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import dbl
from tidemark.session import settle


def regional_features(frame: DataFrame, min_features: int = 2, min_regions: int = 4) -> DataFrame:
    """Long rows (observation_year, region_code, indicator_code, value) of the latest usable year.

    A year is usable if enough indicators cover enough regions and enough regions have all of
    those indicators. Duplicate cells are an error of the caller's data; `duplicate_keys`
    finds them.
    """
    cells = frame.where(F.col("value").isNotNull()).select("observation_year", "indicator_code", "region_code", dbl("value").alias("value"))
    covered = cells.groupBy("observation_year", "indicator_code").agg(F.count(F.lit(1)).alias("regions")).where(F.col("regions") >= min_regions)
    wanted = covered.groupBy("observation_year").agg(F.count(F.lit(1)).alias("features")).where(F.col("features") >= min_features)
    eligible = cells.join(covered.select("observation_year", "indicator_code"), ["observation_year", "indicator_code"], "left_semi")
    complete = (
        eligible.groupBy("observation_year", "region_code").agg(F.count(F.lit(1)).alias("have"))
        .join(wanted, "observation_year").where(F.col("have") == F.col("features"))
    )
    latest = (
        complete.groupBy("observation_year").agg(F.count(F.lit(1)).alias("regions"))
        .where(F.col("regions") >= min_regions).agg(F.max("observation_year").alias("observation_year"))
    )
    chosen = complete.join(F.broadcast(latest), "observation_year").select("observation_year", "region_code")
    return eligible.join(chosen, ["observation_year", "region_code"], "left_semi")


def feature_matrix(features: DataFrame, codes: list[str]) -> DataFrame:
    """One row per region and one column per indicator. Two values for one cell are refused, not merged; indicators not in `codes` are left out."""
    cells = features.where(F.col("indicator_code").isin(codes)).groupBy("region_code", "indicator_code").agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("n"))
    twice = F.raise_error(F.concat(F.lit("duplicate cell "), F.col("region_code"), F.lit(" "), F.col("indicator_code")))
    cells = cells.withColumn("value", F.when(F.col("n") > 1, twice.cast("double")).otherwise(F.col("value"))).drop("n")
    return cells.groupBy("region_code").pivot("indicator_code", codes).agg(F.max("value")).dropna()


def _scaled(matrix: DataFrame, codes: list[str]) -> DataFrame:
    vectors = VectorAssembler(inputCols=codes, outputCol="raw").transform(matrix)
    return StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(vectors).transform(vectors)


def regional_clusters(matrix: DataFrame, codes: list[str], max_clusters: int = 6, starts: int = 20, iterations: int = 300, seed: int = 42) -> DataFrame:
    """region_code, cluster, pca_1, pca_2, silhouette, cluster_count for the best k.

    The number of fits is fixed (k × starts); each fit is a distributed job over the rows.
    """
    rows = settle(matrix)
    scaled = _scaled(rows, codes).select("region_code", "features")
    upper = min(max_clusters, rows.count() - 1)
    if upper < 2:
        raise ValueError("clustering needs at least four regions and two indicators")
    best = None
    for k in range(2, upper + 1):
        fits = [KMeans(k=k, seed=seed + i, maxIter=iterations).fit(scaled) for i in range(starts)]
        model = min(fits, key=lambda m: m.summary.trainingCost)
        assigned = model.transform(scaled)
        if sum(size > 0 for size in model.summary.clusterSizes) < 2:
            continue
        score = ClusteringEvaluator().evaluate(assigned)
        if best is None or score > best[0]:
            best = (score, k, assigned)
    score, k, assigned = best
    return pca_2d(assigned).select(
        "region_code", F.col("prediction").alias("cluster"), "pca_1", "pca_2",
        F.lit(score).alias("silhouette"), F.lit(k).alias("cluster_count"),
    )


def pca_2d(vectors: DataFrame) -> DataFrame:
    """Project the centred `features` column on its two main axes."""
    model = PCA(k=2, inputCol="features", outputCol="__pca").fit(vectors)
    point = vector_to_array(F.col("__pca"))
    return model.transform(vectors).withColumn("pca_1", point[0]).withColumn("pca_2", point[1]).drop("__pca")


def scaled_features(matrix: DataFrame, codes: list[str]) -> DataFrame:
    return _scaled(matrix, codes)
