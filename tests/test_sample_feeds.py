from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from workload.sample_feeds import _rounded_text, _text


def test_texts_of_rounded_doubles_are_those_of_decimals(spark):
    rng, x = random.Random(3), F.col("x")
    values = [None, 0.0, -0.0, -1.005, -24.995, 1e9, 2e9, 98.99995, 99.0, 0.00005, 1.005, 2.675, 24.995, 25.0, 12.5, 37.5]
    values += [f(k / 200, 1e9) for k in range(0, 4000) for f in (math.nextafter, lambda v, _: v)]
    values += [25.0 * k for k in range(500)] + [round(rng.uniform(0, 1e5), rng.choice((2, 3, 5))) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    full = _text((x.cast("decimal(12,2)") * F.lit("0.0002").cast("decimal(6,4)")).cast("decimal(12,2)"))
    assert df.where(~full.eqNullSafe(_rounded_text(x, 2, 10**9, full, factor=5000))).count() == 0
    share = _text(x.cast("decimal(6,4)"))
    assert df.where("x IS NULL OR abs(x) < 99.9").where(~share.eqNullSafe(_rounded_text(x, 4, 99, share))).count() == 0
    # Without the slow form, ordinary amounts still have a text.
    assert df.where("x BETWEEN 1 AND 90").where(_rounded_text(x, 2, 10**9, F.lit(None)).isNotNull()).count() > 5
