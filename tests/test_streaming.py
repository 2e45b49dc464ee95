"""Incremental landing-zone refresh (availableNow file stream)."""

import json
import os

from tradelens.operators import quality as Q
from tradelens.operators import warehouse as W
from tradelens.streaming.landing import start_refresh


def _doc(values, code="440929", year=2020, partner="India"):
    return {"data": [{"refYear": year, "refMonth": m, "partnerCode": 356, "partnerDesc": partner,
                      "reporterDesc": "India", "cmdCode": code, "cmdDesc": "d",
                      "primaryValue": v, "qty": 1.0} for m, v in values]}


def test_refresh_replaces_newest_snapshot_only(spark, tmp_dir):
    raw, wh = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "wh")
    ckpt = os.path.join(tmp_dir, "stream_ckpt")
    os.makedirs(raw)
    iso = spark.createDataFrame([("India", "IND")], "name string, iso string")

    def land(name, doc):
        with open(f"{raw}/comtrade_{name}.json", "w") as f:
            json.dump(doc, f)

    def refreshed():
        q = start_refresh(spark, raw, wh, iso, [Q.not_null("fob_usd")], checkpoint_location=ckpt)
        assert q.awaitTermination(120)
        return sorted((r["hs_code"], r["year"], r["fob_usd"], r["is_outlier"])
                      for r in W.read_current(spark, wh, "fact_shipment").collect())

    land("440929_2020_20240101", _doc([(1, 10.0), (2, 20.0)]))
    land("130232_2020_20240101", _doc([(1, 5.0)], code="130232"))
    assert len(refreshed()) == 3
    # a newer snapshot of one (code, year) replaces exactly that slice
    land("440929_2020_20240301", _doc([(1, 11.0), (2, 21.0), (3, 31.0)]))
    newest = [("130232", 2020, 5.0, False)] + [("440929", 2020, v, False) for v in (11.0, 21.0, 31.0)]
    assert refreshed() == newest
    # an older one that arrives later does not
    land("440929_2020_20240201", _doc([(1, 1.0)]))
    assert refreshed() == newest
    # outliers are judged over all years of a product, in old slices too
    land("440929_2019_20240301", _doc([(m, 12.0) for m in range(1, 13)], year=2019))
    land("440929_2018_20240301", _doc([(m, 12.0) for m in range(1, 13)], year=2018))
    assert [r[2] for r in refreshed() if r[3]] == [31.0]
    # a slice of which no row survives is emptied
    land("130232_2020_20240301", _doc([(1, -5.0)], code="130232"))
    assert not [r for r in refreshed() if r[0] == "130232"]
