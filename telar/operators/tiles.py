"""Features of vector tiles without their repetition across zooms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telar.config import SUMMARY_VALUES


def richness(props: Column) -> Column:
    """How many attributes have a value."""
    return F.coalesce(F.size(F.map_filter(props, lambda k, v: v.isNotNull() & (F.trim(v) != ""))), F.lit(0))


def max_zoom(features: DataFrame, most: int | None = None) -> DataFrame:
    """(fid, fuente): each feature in the tiles of its largest zoom; with ``most``, in the first so many by path.

    The largest zoom per feature is a mergeable maximum, so a feature in a third of the tiles is no burden.
    """
    f = features.select("fid", "fuente", "zoom").where("fid IS NOT NULL").distinct()
    top = f.groupBy("fid").agg(F.max("zoom").alias("zoom"))
    kept = f.join(top, ["fid", "zoom"]).select("fid", "fuente", "zoom")
    if most is None:
        return kept
    return kept.withColumn("r", F.row_number().over(W.partitionBy("fid").orderBy("fuente"))).where(F.col("r") <= most).drop("r")


def richest(features: DataFrame) -> DataFrame:
    """(fid, fuente, riqueza, props): the version of each feature with most values, the first by path among equals."""
    f = features.where("fid IS NOT NULL").select("fid", "fuente", richness(F.col("props")).alias("riqueza"), F.to_json("props").alias("props"))
    best = F.min_by(F.struct("fuente", "riqueza", "props"), F.struct(-F.col("riqueza"), F.col("fuente"), F.col("props")))
    return f.groupBy("fid").agg(best.alias("b")).select("fid", "b.fuente", "b.riqueza", F.from_json("b.props", "map<string,string>").alias("props"))


def assigned(features: DataFrame) -> DataFrame:
    """(fuente, fid, props): the tiles as they are emitted, each feature once per assigned tile and in its richest version."""
    return max_zoom(features).select("fid", "fuente").join(richest(features).select("fid", "props"), "fid")


def inconsistent(features: DataFrame, attribute: str = "name") -> DataFrame:
    """(fid, n): features with several values of an attribute."""
    v = F.trim(F.try_element_at("props", F.lit(attribute)))
    return features.where("fid IS NOT NULL").select("fid", v.alias("v")).where("v <> ''").groupBy("fid").agg(F.count_distinct("v").alias("n")).where("n > 1")


def summary(features: DataFrame, most: int = SUMMARY_VALUES) -> DataFrame:
    """(fuente, clave, n, valores): per tile and key the distinct values that are no numbers; above ``most`` only their number."""
    rows = features.select("fuente", F.explode("props").alias("clave", "v")).select("fuente", "clave", F.trim("v").alias("v"))
    rows = rows.where("v <> ''").where(~F.col("v").rlike(r"^[-+]?[0-9]+([.,][0-9]+)?$")).distinct()
    n = rows.groupBy("fuente", "clave").agg(F.count("*").alias("n"))
    few = rows.join(n.where(F.col("n") <= most), ["fuente", "clave"]).groupBy("fuente", "clave").agg(F.array_join(F.array_sort(F.collect_list("v")), "; ").alias("valores"))
    return n.join(few, ["fuente", "clave"], "left").select("fuente", "clave", "n", "valores")


def statistics(features: DataFrame) -> DataFrame:
    """(zoom, tiles, features, unicos): the repetition by zoom."""
    return features.groupBy("zoom").agg(F.count_distinct("fuente").alias("tiles"), F.count("*").alias("features"), F.count_distinct("fid").alias("unicos"))


def manifest(features: DataFrame) -> DataFrame:
    """(serie, tiles, capas, zoom_min, zoom_max, features): one row per tile series, the folder above ``tiles``."""
    serie = F.regexp_extract("fuente", r"^(.*?)/tiles/", 1)
    return features.groupBy(serie.alias("serie")).agg(F.count_distinct("fuente").alias("tiles"), F.count_distinct("capa").alias("capas"), F.min("zoom").alias("zoom_min"), F.max("zoom").alias("zoom_max"), F.count("*").alias("features"))


#: Attributes in the order in which a feature is described; popups come first, each text once.
POPUPS = ("popup_es", "popup_pt", "popup_en")


def described(features: DataFrame, attributes: tuple[str, ...] = ("name", "class", "area")) -> DataFrame:
    """(fuente, fid, linea): a feature as one line, its popups or else its attributes in a fixed order."""
    value = lambda k: F.nullif(F.trim(F.coalesce(F.try_element_at("props", F.lit(k)), F.lit(""))), F.lit(""))
    popups = F.array_distinct(F.array_compact(F.array(*[value(k) for k in POPUPS])))
    plain = F.concat_ws(" | ", *[F.when(value(k).isNotNull(), F.concat(F.lit(f"{k}: "), value(k))) for k in attributes])
    return features.select("fuente", "fid", F.when(F.size(popups) > 0, F.concat(F.lit("popup: "), F.array_join(popups, "; "))).otherwise(plain).alias("linea")).where("linea <> ''")
