"""The domain feature pipeline end to end on hand-made source tables (declared schemas)."""

import datetime as dt

from hourgrid.plans.features import LAG_SPECS_BASELINE, build_feature_table
from hourgrid.sources import schemas

D0 = dt.datetime(2021, 9, 1)


def _tables(spark):
    hours = [D0 + dt.timedelta(hours=h) for h in range(24 * 10)]
    train = []
    rid = 0
    for t in hours:
        block = (t - D0).days
        for cons in (False, True):
            target = None if (t.hour == 3 and t.day == 5) else float((t.hour + 1) * (2 if cons else 1))
            train.append((0, False, 1, target, cons, t, block, rid, 0))
            rid += 1
    client = [(1, 0, 10 + b, 100.0 + b, False, (D0 + dt.timedelta(days=b)).date(), b + 2) for b in range(10)]
    client.append((1, 0, 0, 0.0, False, D0.date(), 0))   # zero capacity / zero count
    gas = [((D0 + dt.timedelta(days=b)).date(), 40.0 + b, 50.0 + b, D0.date(), b) for b in range(1, 10)]
    elec = [(t, 90.0 + t.hour, t - dt.timedelta(days=2), (t - D0).days) for t in hours]
    fw = []
    for day in range(10):
        origin = D0 + dt.timedelta(days=day)
        for ha in range(1, 49):
            for lat, lon in ((57.6, 21.7), (57.9, 22.2)):
                fw.append((lat, lon, origin, ha, 5.0 + ha / 10, 1.0, 0.1, 0.2, 0.3, 0.4, 3.0, 4.0, day,
                           origin + dt.timedelta(hours=ha), -1.0 if ha == 5 else 100.0, 50.0, 0.00005, 0.0002))
    hw = [(t, 4.0, 1.0, 0.0, 0.5, 1000.0, 50.0, 10.0, 20.0, 30.0, 3.0, 180.0, 10.0, 5.0, 5.0, lat, lon,
           (t - D0).days) for t in hours for lat, lon in ((57.6, 21.7), (57.9, 22.2))]
    st = [(21.7, 57.6, "Harjumaa", 0), (22.2, 57.9, None, None)]
    hol = [(dt.date(2021, 9, 3), "x", "public"), (dt.date(2021, 9, 3), "y", "school"), (dt.date(2021, 9, 4), "z", "public")]
    mk = lambda rows, name: spark.createDataFrame(rows, schemas.SCHEMAS[name])
    return {
        "train": mk(train, "train"), "client": mk(client, "client"), "gas_prices": mk(gas, "gas_prices"),
        "electricity_prices": mk(elec, "electricity_prices"), "forecast_weather": mk(fw, "forecast_weather"),
        "historical_weather": mk(hw, "historical_weather"),
        "weather_station_to_county_mapping": mk(st, "weather_station_to_county_mapping"),
        "holidays": mk(hol, "holidays"),
    }


def test_feature_table_end_to_end(spark):
    tables = _tables(spark)
    out = build_feature_table(tables, LAG_SPECS_BASELINE, validate=True)
    cols = out.columns
    for c in ("eic_count", "lowest_price_per_mwh", "euros_per_mwh", "f0d_temperature", "f1d_windspeed",
              "h2d_u_component", "h1d_rain_mm", "public", "school", "dst", "hour", "week_of_year",
              "target_lag_2d", "target_lag_3d", "target_lag_7d", "target_lag_2d_6h_win_mean",
              "target_lag_7d_24h_win_mean", "target_to_capacity", "capacity_to_eic"):
        assert c in cols, c
    assert "data_block_id" not in cols and "date" not in cols
    n_train = tables["train"].dropna().count()
    assert out.count() == n_train                      # left joins keep every fact row once
    r = out.filter("datetime = '2021-09-04 12:00:00' AND NOT is_consumption").collect()[0]
    assert r["target_lag_2d"] == 13.0                   # 2021-09-02 12:00 target
    assert r["target_lag_2d_6h_win_mean"] == sum(range(7, 13)) / 6
    assert r["eic_count"] == 11.0 and r["installed_capacity"] == 101.0   # block 3 -> client block 3
    assert r["public"] is True and r["school"] is False
    assert r["f1d_surface_solar_radiation_downwards"] == 50.0
    assert r["f1d_snowfall_mm"] == 0.0 and r["f1d_total_precipitation_mm"] == 0.2
    assert r["dst"] is True
    z = out.filter("datetime = '2021-09-01 05:00:00' AND NOT is_consumption").collect()[0]
    assert z["f1d_direct_solar_radiation"] is None or z["f1d_direct_solar_radiation"] >= 0.0


def test_staged_workflow_equals_one_call(spark):
    from hourgrid.plans.workflow import FeatureWorkflow

    tables = _tables(spark)
    wf = (FeatureWorkflow(spark).load(tables).prepare().merge().transform_datetime()
          .add_lags_and_rollings("target", LAG_SPECS_BASELINE).add_ratio_features())
    one = build_feature_table(tables, LAG_SPECS_BASELINE)
    assert wf.df.columns == one.columns
    assert wf.df.exceptAll(one).count() == 0 and one.exceptAll(wf.df).count() == 0
