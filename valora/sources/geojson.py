"""GeoJSON feature collections.

Coordinates are declared as STRING so Spark keeps their raw JSON text
(Polygon and MultiPolygon nest differently and schema inference flattens
them); validity and edges are then derived per geometry type with
``from_json`` (see ``operators.spatial``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valora.operators.spatial import geometry_is_valid
from valora.sources.json_split import read_objects

GEOMETRY = T.StructType([T.StructField("type", T.StringType()),
                         T.StructField("coordinates", T.StringType())])


def read_features(spark: SparkSession, path: str, properties: T.StructType) -> DataFrame:
    """One row per feature: the declared properties plus ``geometry``.  The file
    is read in splits; a feature that is no valid JSON has neither."""
    feature = T.StructType([T.StructField("properties", properties), T.StructField("geometry", GEOMETRY)])
    parsed = read_objects(spark, path, 2).select(F.from_json("value", feature).alias("feature"))
    return parsed.select("feature.properties.*", "feature.geometry")


# Fixed value: the attribute fields of a noise-zone feature.
ZONE_PROPERTIES = T.StructType([T.StructField("ZONE", T.StringType()), T.StructField("NOM", T.StringType())])


def noise_zones(spark: SparkSession, path: str, keep_null_geometry: bool = False,
                properties: T.StructType = ZONE_PROPERTIES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Noise-zone table  (C15 = S9 + G1 + K6, A11).

    Returns ``(attributes, geometries, rejected_count)``: the attribute
    table without geometry (what the reference stores), the valid features
    with geometry (kept for the point-in-zone join) and a one-row count of
    rejected geometries.  A NULL geometry is kept or rejected per
    ``keep_null_geometry`` — the reference's two scripts disagree (Q9)."""
    return split_zones(read_features(spark, path, properties), keep_null_geometry)


def split_zones(feats: DataFrame, keep_null_geometry: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``noise_zones`` of features that are read already."""
    valid = geometry_is_valid(F.col("geometry"))
    keep = F.coalesce(valid, F.lit(keep_null_geometry))
    kept = feats.where(keep)
    rejected = feats.agg(F.count_if(~keep).alias("n_rejected"))
    return kept.drop("geometry"), kept.where(F.col("geometry").isNotNull()), rejected
