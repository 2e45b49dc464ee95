"""Golden replays of the reference's published small results (numbers copied
from its committed summary tables, not the files)."""

from pyspark.sql import functions as F

from tradelens.operators import benchmark as B
from tradelens.params import BenchmarkParams

# code, base-year volume (kg), gap vs competitor A, crore vs A, gap vs B, crore vs B
SUMMARY = [
    ("440929", 789332.627, -1.9268, 0.0, -0.7098, 0.0),
    ("442090", 1661638.372, 7.3673, 30.48, 18.3204, 75.8),
    ("330749", 8723148.022, 4.6007, 99.93, 5.7169, 124.17),
    ("130232", 169354468.462, 10.0841, 4252.4, 31.3867, 13235.54),
    ("130239", 10081882.302, 5.1222, 128.59, 14.4699, 363.25),
]


def test_opportunity_golden_replay(spark):
    params = BenchmarkParams(base_reporter="India", competitors=("Vietnam", "Morocco"),
                             base_year=2023)
    gaps = spark.createDataFrame(
        [(c, "Vietnam", ga) for c, _, ga, _, _, _ in SUMMARY]
        + [(c, "Morocco", gb) for c, _, _, _, gb, _ in SUMMARY],
        "product string, competitor string, gap double")
    panel = spark.createDataFrame([("India", 2023, c, v, 0.0) for c, v, *_ in SUMMARY],
                                  "reporter string, year int, product string, qty double, fob double")
    opp = B.opportunity(gaps, panel, "India", params)
    got = {(r["product"], r["competitor"]): r["opportunity_inr_cr"] for r in opp.collect()}
    for c, _, _, cra, _, crb in SUMMARY:
        # the committed gaps carry 4 dp, so a crore figure may move by one cent
        assert abs(got[(c, "Vietnam")] - cra) <= 0.011
        assert abs(got[(c, "Morocco")] - crb) <= 0.011
    tot = B.opportunity_totals(opp, ("130232", "130239"), "Morocco").first()
    assert abs(tot["total_inr_cr"] - 18310.16) <= 0.02
    assert abs(tot["adjusted_inr_cr"] - 4711.37) <= 0.02
    fx = {r["fx_rate"]: r["scaled_inr_cr"] for r in
          B.fx_sensitivity(opp.agg(F.lit(tot["adjusted_inr_cr"]).alias("adjusted_inr_cr")),
                           83.0, (80.0, 83.0, 85.0, 87.0)).collect()}
    assert abs(fx[83.0] - tot["adjusted_inr_cr"]) < 1e-9
    assert fx[80.0] < fx[83.0] < fx[85.0] < fx[87.0]
