"""Guide-page responses and image loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse.functions import rates as R
from viewpulse.model import D5, DETAIL_PAGE, RESOLUTIONS
from viewpulse.operators.cube import Measures, cube_all
from viewpulse.operators.series import multi_resolution


def band_measures() -> Measures:
    band = R.epg_band(F.col("http_rsp_time"))
    return {f"band{i}": ("sum", F.when(band == i, F.col("requests")).otherwise(0).cast("bigint")) for i in range(1, 5)}


def mean_measures() -> Measures:
    return {"rsp_sum": ("sum", F.col("requests") * F.col("http_rsp_time")), "requests": ("sum", F.col("requests"))}


def image_measures() -> Measures:
    return {"requests": ("sum", F.col("requests")), "suc": ("sum", F.col("suc_cnt")),
            "le3s": ("sum", F.col("le3s_cnt"))}


def epg_bands(epg: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ()) -> DataFrame:
    """Requests per response-time band and page type."""
    return cube_all(epg, dims, band_measures(), (*fixed, "page_type"))


def with_epg_mean(sums: DataFrame) -> DataFrame:
    mean = R.whole_mean(F.col("rsp_sum"), F.col("requests"))
    return sums.where("requests <> 0").withColumn("mean_rsp_time", mean).drop("rsp_sum")


def epg_mean(epg: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ()) -> DataFrame:
    """Response time weighted by requests, whole microseconds; no row without requests."""
    return with_epg_mean(cube_all(epg, dims, mean_measures(), (*fixed, "page_type")))


def epg_resolutions(epg: DataFrame, dims: Sequence[str] = D5, resolutions: dict[int, str] = RESOLUTIONS) -> DataFrame:
    """Bands and means at 1, 15 and 60 minutes from one pass over the log."""
    sums = multi_resolution(epg, dims, {**band_measures(), **mean_measures()}, ("page_type",), resolutions)
    return sums.withColumn("mean_rsp_time", R.whole_mean(F.col("rsp_sum"), F.col("requests"))).drop("rsp_sum")


def detail_load_success(epg: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ()) -> DataFrame:
    """Loaded detail pages over requested ones."""
    detail = epg.where(F.col("page_type") == DETAIL_PAGE)
    sums = cube_all(detail, dims, {"_suc": ("sum", F.col("page_suc_cnt")), "_all": ("sum", F.col("requests"))}, fixed)
    return sums.where("_all <> 0").select(*fixed, *dims, R.rate4(F.col("_suc"), F.col("_all")).alias("load_succ_rate"))


def with_image_rates(sums: DataFrame) -> DataFrame:
    kept = [c for c in sums.columns if c not in ("requests", "suc", "le3s")]
    whole = F.col("requests")
    return sums.where("requests <> 0").select(*kept, R.rate4(F.col("suc"), whole).alias("succ_rate"),
                                              R.rate4(F.col("le3s"), whole).alias("fast_rate"))


def image_rates(images: DataFrame, dims: Sequence[str] = D5, fixed: Sequence[str] = ()) -> DataFrame:
    """Success rate and share loaded within three seconds; no row without requests."""
    return with_image_rates(cube_all(images, dims, image_measures(), fixed))


def image_resolutions(images: DataFrame, dims: Sequence[str] = D5,
                      resolutions: dict[int, str] = RESOLUTIONS) -> DataFrame:
    """Image rates at 1, 15 and 60 minutes; sums are merged, rates divided last."""
    return with_image_rates(multi_resolution(images, dims, image_measures(), (), resolutions))
