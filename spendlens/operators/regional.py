"""Spend-vs-visits joins without nested loops or fan-out.

``match_regions`` replaces the disjunctive join
``campaign_region = 'National' OR campaign_region = mapped_region`` (which
Spark can only plan as a nested-loop join) by an equi-join for regional rows
plus a per-week total for the national row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NATIONAL = "National"


def match_regions(campaign_regions: DataFrame, totals: DataFrame, *, keys: Sequence[str],
                  value: str, region: str = "region", mapped: str = "mapped_region",
                  out_region: str = "campaign_region") -> DataFrame:
    """Sum ``value`` of ``totals`` (grain ``keys`` x ``mapped``) for every
    campaign region: National takes all mapped regions (NULL ones too),
    East/West their own."""
    regions = campaign_regions.select(F.col(region).alias(out_region)).distinct()
    regional = (regions.filter(F.col(out_region) != NATIONAL)
                .join(totals, F.col(out_region) == totals[mapped])
                .groupBy(*keys, out_region).agg(F.sum(value).alias(value)))
    # "is there a National campaign region?" is one scalar, evaluated once as
    # a subquery (a semi join on the constant would plan as a nested loop)
    has_national = regions.filter(F.col(out_region) == NATIONAL) \
        .select(F.count(F.lit(1))).scalar() > 0
    national = (totals.groupBy(*keys).agg(F.sum(value).alias(value))
                .filter(has_national)
                .withColumn(out_region, F.lit(NATIONAL)))
    return regional.unionByName(national.select(*keys, out_region, value))
