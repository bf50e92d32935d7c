"""Invariants of the builds and shape of the physical plans."""

import io
from contextlib import redirect_stdout

import pytest
from conftest import FOLDER
from pyspark.sql import functions as F

from cargolith.catalog import binding as b
from cargolith.functions import statistics as st
from cargolith.operators import keyed
from cargolith.plans import facts, features, kpis, models, quality
from cargolith.plans import timeseries as ts
from cargolith.sources import operational as op
from cargolith.sources.marts import invoices, shipments
from cargolith.sources.tables import parquet

col = F.col


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_shipment_rows_are_kept_or_rejected(spark):
    tagged = b.ship_tagged(spark, FOLDER)
    assert tagged.count() == b.ship_rows(spark, FOLDER).count()
    fact = b.fact_shipments(spark, FOLDER)
    kept = tagged.filter("RejectReason IS NULL").select("ShipmentID").distinct().count()
    assert fact.count() == kept == fact.select("ShipmentID").distinct().count()
    assert fact.filter(" OR ".join(f"{c} IS NULL" for c in ("CustomerKey", "EquipmentKey", "TotalWeight", "TotalPackages"))).count() == 0


def test_a_name_of_many_parties_multiplies_nothing(spark):
    parties = spark.range(1000).select(F.when(col("id") % 2 == 0, "Twin").otherwise("Unknown").alias("Name"), col("id").alias("Key"))
    names = facts.one_key_per_name(parties.withColumn("Name", facts.plain_name(col("Name"))), ["Name"], "Key")
    rows = spark.range(1000).select("id", F.when(col("id") < 400, "twin").otherwise("unknown").alias("Name")).join(names, "Name", "left")
    assert rows.count() == 1000
    assert rows.filter("Key = 0").count() == 400 and rows.filter("Key IS NULL").count() == 600


def test_training_features_read_the_source_once(spark):
    wide, narrow = (plan(features.shipment_features(shipments(spark, FOLDER), labels=x)) for x in (True, False))
    scans = [text.count("Scan parquet  (") or text.count("Scan parquet") for text in (wide, narrow)]
    assert scans[1] < scans[0]


def test_seasons_add_up(spark):
    s, i = shipments(spark, FOLDER, "ShipmentDate"), invoices(spark, FOLDER)
    total = kpis.counts_by_season(s, "ShipmentDate", "n").agg(F.sum("n")).first()[0]
    assert total == s.count()
    assert kpis.cash_flow(i).agg(F.sum("InvoiceCount")).first()[0] == i.count()


def test_invoice_keys_of_both_kinds_can_be_kept_apart(spark):
    tagged = b.inv_tagged(spark, FOLDER)
    wide = facts.fact_invoices(tagged, ("InvoiceID", "InvoiceType"))
    assert wide.count() >= facts.fact_invoices(tagged).count()


def test_scans_are_pruned_and_filters_pushed(spark):
    text = plan(kpis.counts_by_season(shipments(spark, FOLDER, "ShipmentDate"), "ShipmentDate", "n"))
    assert "l_extendedprice" not in text and "o_totalprice" not in text and "part.parquet" not in text
    text = plan(parquet(spark, FOLDER, "lineitem").filter(col("l_shipdate").isNotNull()).select("l_orderkey"))
    assert "IsNotNull(l_shipdate)" in text


def test_choice_per_key_is_cut_before_the_shuffle(spark):
    df = keyed.first_per_key(parquet(spark, FOLDER, "orders"), ["o_custkey"], [col("o_orderdate").desc(), col("o_orderkey")])
    text = plan(df)
    assert text.count("WindowGroupLimit") >= 2


def test_facts_meet_no_single_partition_and_no_cartesian_product(spark):
    for df in (b.fact_shipments(spark, FOLDER), b.fact_invoices(spark, FOLDER)):
        text = plan(df)
        assert "CartesianProduct" not in text and "SinglePartition" not in text.split("== Initial Plan ==")[-1].split("BroadcastExchange")[0]


def test_rules_come_from_one_job(spark):
    df = quality.fact_shipment(b.ship_rows(spark, FOLDER), ["ShipmentID", "TotalWeight"])
    assert {r.rule for r in df.collect()} == {"null_ShipmentID", "null_TotalWeight", "duplicate_ShipmentID"}
    with pytest.raises(ValueError):
        quality.enforce(df)
    with pytest.raises(ValueError):
        quality.fact_shipment(b.ship_rows(spark, FOLDER), ["NoSuchColumn"])


def test_tail_probabilities(spark):
    import math

    import numpy as np

    x = [0.0, 0.3, 1.0, 1.96, 3.5]
    got = [r.v for r in spark.createDataFrame([(v,) for v in x], "z double").select(st.two_sided_normal(col("z")).alias("v")).collect()]
    assert np.allclose(got, [math.erfc(v / math.sqrt(2)) for v in x], rtol=2e-7)
    # Known values: t(10) = 2.228139 and t(3) = 3.182446 cut 5 %, t(1) = 1 cuts one half.
    assert np.allclose(st.student_two_sided(np.array([2.228139, 3.182446, 1.0, 0.0]), np.array([10, 3, 1, 5])), [0.05, 0.05, 0.5, 1.0], atol=1e-6)
    k = spark.range(1).select(st.kolmogorov_tail(F.lit(1.358099)).alias("v")).first().v
    assert abs(k - 0.05) < 1e-5


def make_series(spark, n, f):
    import datetime as dtm

    rows = [("s", dtm.date(2024, 1, 1) + dtm.timedelta(days=i), float(f(i))) for i in range(n)]
    return spark.createDataFrame(rows, "series_id string, ds date, y double")


def test_short_series_fall_back(spark):
    three = ts.naive_forecast(make_series(spark, 3, lambda i: i), 4).collect()
    assert {r.method for r in three} == {"mean"} and {r.yhat for r in three} == {1.0}
    week = ts.naive_forecast(make_series(spark, 7, lambda i: i), 9).orderBy("ds").collect()
    assert [r.yhat for r in week] == [0, 1, 2, 3, 4, 5, 6, 0, 1]


def test_forecasts_follow_a_line_and_a_season(spark):
    line = make_series(spark, 60, lambda i: 10 + 2 * i)
    for method in (ts.smoothing_forecast, ts.autoregressive_forecast):
        got = [r.yhat for r in method(line, 5).orderBy("ds").collect()]
        assert all(abs(g - (10 + 2 * (60 + k))) < 3 for k, g in enumerate(got)), (method, got)
    errors = ts.backtest(line).collect()
    assert all(r.mape < 5 for r in errors)
    season = make_series(spark, 70, lambda i: 50 + 10 * (i % 7))
    assert ts.seasonality(season).first().seasonal_strength > 0.95
    t = ts.trend(line).first()
    assert t.trend_type == "increasing" and abs(t.slope - 2) < 1e-9


def test_split_ignores_partitioning(spark):
    df = shipments(spark, FOLDER, "ShipmentID")
    a = models.train_test(df.repartition(3), "ShipmentID")[1].distinct()
    c = models.train_test(df.repartition(11), "ShipmentID")[1].distinct()
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0
    share = models.train_test(df, "ShipmentID")[1].count() / df.count()
    assert 0.15 < share < 0.25


def test_models_beat_the_mean(spark):
    from cargolith.catalog.learn import regression_data
    from cargolith.plans import evaluation as ev

    data, _ = regression_data(spark, FOLDER)
    train, test = models.train_test(data, "ShipmentID")
    fitted = models.fit_all(train, {n: models.REGRESSORS[n] for n in ("ridge", "random_forest")})
    rows = ev.regression_metrics(models.predictions(fitted, test, "ShipmentID"), ["model"]).collect()
    assert all(r.r2 > 0.3 for r in rows)


def test_weighted_vote(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.0), (2.0, 2.0, 1.0), (1.0, 0.0, 2.0)], "pred_a double, pred_b double, pred_c double")
    got = [r.v for r in df.select(models.weighted_vote({"a": 0.5, "b": 0.3, "c": 0.3}).alias("v")).collect()]
    assert got == [0.0, 2.0, 1.0]


def test_rejects_of_all_rules_come_from_one_scan(spark):
    rows = [("a", "unmatched_customer", None, 1), ("a", "unmatched_customer", None, 2), (None, "unmatched_customer", None, 3),
            ("b", "unmatched_supplier", 4, 4), ("c", None, None, 5), ("c", None, 6, 5), ("d", "invalid_datekey", None, 7)]
    tagged = spark.createDataFrame(rows, "PartyName string, RejectReason string, PaymentTermKey long, PaymentTermID long")
    got = facts.invoice_rejects(tagged)
    assert {k: sorted(str(r[0]) for r in v.collect()) for k, v in got.items()} == {
        "unmatched_customers": ["None", "a"], "unmatched_suppliers": ["b"], "unmatched_payment_terms": ["5"]}
    # Every output reads what the one scan wrote, not the tagged rows.
    assert len({tuple(v.inputFiles()) for v in got.values()}) == 1 and got["unmatched_customers"].inputFiles()
