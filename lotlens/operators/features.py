"""Model rows: derived features, selection, stable split, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as x
from ..functions import vocab as v


def derive_features(df: DataFrame, sum_vehicles_first: bool = True) -> DataFrame:
    """Log price and the eight derived features; a zero divisor gives NULL.

    `sum_vehicles_first` says whether garage and carport are added before
    dividing by the road width.
    """
    c = F.col
    out = df.withColumns({
        "price": F.log("price"),
        "total_beds": c("kamar_tidur") + c("kamar_pembantu"),
        "total_baths": c("kamar_mandi") + c("kamar_mandi_pembantu"),
        "land_building_ratio": F.try_divide("luas_tanah", "luas_bangunan"),
        "bed_bath_ratio": F.try_divide("kamar_tidur", "kamar_mandi"),
        "rennovated_built_diff": c("tahun_di_renovasi") - c("tahun_dibangun"),
        "building_area_floor_ratio": F.try_divide("luas_bangunan", "jumlah_lantai"),
        "vehicle_accessibility": F.try_divide(c("garasi") + c("carport"), "lebar_jalan") if sum_vehicles_first
        else c("garasi") + F.try_divide("carport", "lebar_jalan"),
    })
    return out.withColumn("total_bed_bath_ratio", F.try_divide("total_beds", "total_baths"))


def select_features(df: DataFrame, columns: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """The model columns, text ones without NULL; `keep` names key columns to carry along."""
    out = df.select(*(keep or []), *(columns or v.MODEL_COLUMNS))
    return out.fillna("", [f.name for f in out.schema if f.dataType.typeName() == "string"])


def bucket_of(key: Column | str, seed: int, buckets: int = 1000) -> Column:
    """Bucket of a key by its hash: the same in every run and partitioning."""
    h = F.md5(F.concat_ws("-", F.lit(str(seed)), x.col(key).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % buckets


def split(df: DataFrame, key: str, test: float = 0.33, seed: int = 22) -> tuple[DataFrame, DataFrame]:
    """Train and test rows."""
    is_test = bucket_of(key, seed) < int(round(test * 1000))
    return df.filter(~is_test), df.filter(is_test)


def regression_metrics(df: DataFrame, actual: str = "price", predicted: str = "prediction") -> DataFrame:
    """Moments of the prediction and its errors, in one pass."""
    y, p = F.col(actual), F.col(predicted)
    err = F.abs(y - p)
    return df.agg(
        F.avg(p).alias("mean"), F.stddev_pop(p).alias("std"), F.var_pop(p).alias("var"),
        (1 - F.sum((y - p) * (y - p)) / (F.var_pop(y) * F.count(y))).alias("r2"),
        F.avg((y - p) * (y - p)).alias("mse"), F.avg(err).alias("mae"),
        F.avg(F.try_divide(err, F.abs(y))).alias("mape"),
        F.avg(F.try_divide(err, (F.abs(y) + F.abs(p)) / 2)).alias("smape"),
    )
