"""Feed quality against plain counting."""
from __future__ import annotations

import math

from pyspark.sql import functions as F

from clickgauge.operators import feedquality as FQ


def test_clock_skew_is_exact_beyond_ten_thousand_skews(spark):
    n = 200_000
    hits = spark.range(0, n, 1, 8).select((F.col("id") * 7919 % 199_999 + 1_700_000_000).alias("local"), F.lit("1700000000").alias("gmt"))
    hits = hits.unionByName(spark.range(3).select(F.lit(None).cast("long").alias("local"), F.lit("x").alias("gmt")))
    skews = sorted(i * 7919 % 199_999 for i in range(n))
    local = F.timestamp_seconds("local")
    got = FQ.clock_skew(hits, local, "gmt").first()
    assert list(got) == [skews[math.ceil(n * p / 100) - 1] for p in (5, 50, 95)]
    assert FQ.clock_skew(hits.limit(0), local, "gmt").first()["p50"] is None
