"""The venue view reproduces the counts documented for the fixtures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from ratelake.contract import CRITICAL_COLUMNS
from ratelake.operators.quality import split
from ratelake.plans.venue import venue_pipeline, venue_rows
from ratelake.streaming.consumer import niche_filter

# sf -> rows, null latitude, null avg_rating, null total_reviews_count,
#       null price_level, null gluten_free, countries, cities, good rows,
#       gluten-free with rating >= 4.5 among good rows, rating > 0 among good rows
EXPECTED = {
    SF001: (150, 3, 11, 4, 31, 40, 5, 25, 147, 3, 136),
    SF01: (1500, 30, 122, 38, 356, 303, 5, 25, 1470, 24, 1351),
}


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_venue_view_counts(spark, sf):
    raw = venue_rows(spark, sf)
    nulls = raw.agg(
        F.count(F.lit(1)),
        *[F.count_if(F.col(c).isNull()) for c in
          ("latitude", "avg_rating", "total_reviews_count", "price_level", "gluten_free")],
        F.countDistinct("country"),
        F.countDistinct("city"),
    ).first()
    good, _ = split(raw, CRITICAL_COLUMNS)
    out = venue_pipeline(raw)
    got = (*nulls, good.count(), out.filter(niche_filter()).count(), out.filter("avg_rating > 0").count())
    assert got == EXPECTED[sf]
