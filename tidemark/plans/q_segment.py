"""Regional features, clusters and projection."""

from pyspark.sql import functions as F

from tidemark.operators import segment
from tidemark.plans import panels
from tidemark.plans.registry import query
from tidemark.session import settle

CODES = {"R.543.TV0.TP0": "tax", "R.1975.TV0.TP0": "quantity"}


def matrix(lake):
    features = segment.regional_features(settle(panels.staged(lake, "ledger_regional")))
    named = features.withColumn("indicator_code", F.element_at(F.create_map(*(F.lit(x) for pair in CODES.items() for x in pair)), F.col("indicator_code")))
    return segment.feature_matrix(named, list(CODES.values()))


@query("regional_features", """
SELECT region_code, R(max(value) FILTER (indicator_code LIKE 'R.543%')) AS tax, R(max(value) FILTER (indicator_code LIKE 'R.1975%')) AS quantity
FROM stg_regional WHERE observation_year = (SELECT max(observation_year) FROM stg_regional) GROUP BY 1 HAVING count(DISTINCT indicator_code) = 2
""")
def _(lake):
    return matrix(lake)


@query("regional_clusters")
def _(lake):
    return segment.regional_clusters(matrix(lake), list(CODES.values()))


@query("pca_2d", """
SELECT region_code, R(abs((zt + zq) / sqrt(2.0::DOUBLE))) AS along, R(abs((zt - zq) / sqrt(2.0::DOUBLE))) AS across FROM (
  SELECT region_code, (tax - avg(tax) OVER ()) / stddev_samp(tax) OVER () AS zt, (quantity - avg(quantity) OVER ()) / stddev_samp(quantity) OVER () AS zq FROM (
    SELECT region_code, max(value::DOUBLE) FILTER (indicator_code LIKE 'R.543%') AS tax, max(value::DOUBLE) FILTER (indicator_code LIKE 'R.1975%') AS quantity
    FROM stg_regional WHERE observation_year = (SELECT max(observation_year) FROM stg_regional) GROUP BY 1))
""")
def _(lake):
    # Two standardised features: the axes are the two diagonals; which comes first depends on the
    # sign of the correlation, and the sign of an axis is free. So the result is named by diagonal.
    projected = segment.pca_2d(segment.scaled_features(settle(matrix(lake)), list(CODES.values())))
    same_sign = projected.agg(F.corr("tax", "quantity")).first()[0] > 0
    along, across = ("pca_1", "pca_2") if same_sign else ("pca_2", "pca_1")
    return projected.select("region_code", F.abs(along).alias("along"), F.abs(across).alias("across"))
