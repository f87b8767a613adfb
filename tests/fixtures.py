"""Small tables built in code."""

T0 = 1784124000 * 1_000_000  # 2026-07-15 14:00:00 UTC


def ticks(spark, pairs, spread=0.3, instrument="X", start=T0):
    """From (offset in seconds, bid), in input order."""
    rows = [(instrument, start + round(s * 1_000_000), i, float(b), float(b) + spread) for i, (s, b) in enumerate(pairs)]
    return spark.createDataFrame(rows, "instrument string, ts_us long, seq long, bid double, ask double")
