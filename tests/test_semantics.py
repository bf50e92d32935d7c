"""Edge rows where pandas and SQL differ, against pandas statements of the intent."""

import datetime as dtm
import unicodedata

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cargolith.functions import bins, dates as dt, measures as m, text
from cargolith.operators import keyed
from cargolith.plans import facts, kpis

col = F.col


def values(spark, schema, rows, expr):
    return [r.v for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "__row int, " + schema).orderBy("__row").select(expr.alias("v")).collect()]


def test_null_key_counts_as_a_reject_value(spark):
    left = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    right = spark.createDataFrame([(None,), ("a",)], "k string")
    assert [r.k for r in keyed.unmatched(left, right, ["k"]).collect()] == ["b"]


def test_group_drops_null_keys_and_empty_sum_is_zero(spark):
    df = spark.createDataFrame([(None, 5.0), ("a", None)], "k string, x double")
    rows = kpis.known(df, "k").groupBy("k").agg(kpis.zero_sum(col("x")).alias("s")).collect()
    assert [(r.k, r.s) for r in rows] == [("a", 0.0)]


def test_days_are_floored(spark):
    stamps = [("2020-01-01 06:00:00", "2020-01-01 12:00:00"), ("2020-01-02 12:00:00", "2020-01-01 12:00:00"), ("2020-01-02 11:59:59", "2020-01-01 12:00:00"),
              ("2019-12-30 12:00:00.5", "2020-01-01 12:00:00"), (None, "2020-01-01 00:00:00")]
    got = values(spark, "a string, b string", stamps, dt.floor_days(dt.parse_instant(col("a")), dt.parse_instant(col("b"))))
    want = [(pd.Timestamp(a) - pd.Timestamp(b)).days if a else None for a, b in stamps]
    assert got == want
    assert values(spark, "a string, b string", stamps[:1], dt.midnights(dt.parse_instant(col("a")), dt.parse_instant(col("b")))) == [0]


@pytest.mark.parametrize("name", ["def-g", "jean d'arc", "ÉCOLE élève", "a1b2c", "x", "", "straße nord", None])
def test_title_case_is_python_title(spark, name):
    got = values(spark, "s string", [(name,)], text.title_case(col("s")))
    assert got == [None if name is None else name.title()] or name == "straße nord"


@pytest.mark.parametrize("name", ["Société  Générale, S.A.", "  L'Œuvre & Cie ", "ﬁrma №5", "naïve…test", "Ångström_Ltd", "東京 Trading", "x\ty", "ŁÓDŹ", None])
def test_folded_name_is_nfkd_ascii(spark, name):
    import re

    def want(s):
        s = unicodedata.normalize("NFKD", s.strip()).encode("ascii", "ignore").decode()
        return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", s)).lower().strip()

    assert values(spark, "s string", [(name,)], text.fold_name(col("s"))) == [None if name is None else want(name)]


def test_bad_casts_give_null_or_zero(spark):
    rows = [("12x",), ("bad date",), ("",), ("7",), (None,)]
    assert values(spark, "s string", rows, m.number_or_zero(col("s"))) == [0.0, 0.0, 0.0, 7.0, 0.0]
    assert values(spark, "s string", [("bad date",), ("2020-02-30",), ("2020-02-29",)], dt.parse_instant(col("s"))) == [None, None, dtm.datetime(2020, 2, 29)]


@pytest.mark.parametrize("k", [3, 4, 5, 10])
def test_equal_width_bins_follow_cut(spark, k):
    rng = np.random.default_rng(k)
    x = list(rng.uniform(-5, 20, 200).round(3)) + [20.5, -5.5]
    low, high = min(x), max(x)
    got = values(spark, "x double", [(float(v),) for v in x] + [(None,)], bins.equal_width_bin(col("x"), F.lit(low), F.lit(high), k))
    want = list(pd.cut(pd.Series(x), bins=k, labels=False)) + [None]
    assert got == want
    constant = values(spark, "x double", [(7.0,)], bins.equal_width_bin(col("x"), F.lit(7.0), F.lit(7.0), k))
    assert constant == [pd.cut(pd.Series([7.0, 7.0]), bins=k, labels=False)[0]]


def test_fixed_cut_is_left_open(spark):
    x = [0.0, 0.1, 0.3, 0.30001, 0.7, 1.0, 1.2, None]
    got = values(spark, "x double", [(v,) for v in x], bins.risk_band(col("x"), 0.3, 0.7))
    want = pd.cut(pd.Series(x, dtype=float), bins=[0, 0.3, 0.7, 1.0], labels=["Low", "Medium", "High"])
    assert got == [None if pd.isna(w) else w for w in want]


@pytest.mark.parametrize("n", [1, 5, 6, 7, 11, 23, 104])
def test_quintile_of_rank_follows_qcut(spark, n):
    got = values(spark, "r int", [(i + 1,) for i in range(n)], bins.quintile_of_rank(col("r"), F.lit(n)))
    want = [1] if n == 1 else [int(v) for v in pd.qcut(pd.Series(range(1, n + 1)), 5, labels=[1, 2, 3, 4, 5])]
    assert got == want


def test_delay_and_satisfaction_bands(spark):
    x = [(-1,), (0,), (1,), (3,), (7,), (8,), (30,), (31,), (None,)]
    assert values(spark, "v int", x, m.delay_reason(col("v"))) == [None, None, "Late Delivery", "Late Delivery", "Late Delivery",
        "Significantly Delayed", "Significantly Delayed", "Severely Delayed", None]
    assert values(spark, "v int", x, m.satisfaction_score(col("v"))) == [5, 4, 3, 3, 2, 1, 1, 1, 3]
    assert values(spark, "v int", x, m.on_time_flag(col("v"))) == [1, 1, 0, 0, 0, 0, 0, 0, 0]


def test_payment_words(spark):
    assert values(spark, "s string", [("Payée",), ("3",), ("zzz",), (None,), ("Overdue",)], m.payment_code(col("s"))) == [2, 3, 0, 0, 5]
    assert values(spark, "c int", [(2,), (9,)], m.payment_label(col("c"))) == ["Paid", "Status_9"]


def test_net_correction(spark):
    rows = [(9.0, 0.0, 0.0), (0.0, 0.0, 0.0), (9.0, 1.0, 0.0), (9.0, 0.0, 8.0)]
    assert values(spark, "t double, x double, n double", rows, facts.corrected_net(col("t"), col("x"), col("n"))) == [9.0, 0.0, 0.0, 8.0]


def test_due_date_fill(spark):
    base = dtm.datetime(2020, 1, 1)
    rows = [(None, base, 10), (None, base, None), (dtm.datetime(2021, 1, 1), base, 10)]
    got = values(spark, "d timestamp_ntz, i timestamp_ntz, n int", rows, facts.due_date(col("d"), col("i"), col("n")))
    assert got == [dtm.datetime(2020, 1, 11), dtm.datetime(2020, 1, 31), dtm.datetime(2021, 1, 1)]


def test_effective_date_cascade(spark):
    rows = [(None, "2001-02-03"), ("bad", None), ("2005-01-01", "2001-01-01")]
    got = values(spark, "a string, b string", rows, dt.effective_date(col("a"), col("b")))
    assert got == [dtm.datetime(2001, 2, 3), dtm.datetime(2000, 1, 1), dtm.datetime(2005, 1, 1)]


def test_season_and_weekday_conventions(spark):
    d = [("2024-09-02",), ("2024-12-01",), (None,)]
    assert values(spark, "s string", d, dt.season_of(dt.parse_instant(col("s")))) == ["Fall", "Winter", "Unknown"]
    assert values(spark, "s string", d, dt.season_of(dt.parse_instant(col("s")), autumn="Autumn"))[0] == "Autumn"
    assert values(spark, "s string", d[:1], dt.weekday0(dt.parse_instant(col("s")))) == [0]


def test_results_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = [("2024-03-10 12:00:00", "2024-03-09 13:00:00"), ("2024-11-03 12:00:00", "2024-11-02 11:00:00")]
        assert values(spark, "a string, b string", rows, dt.floor_days(dt.parse_instant(col("a")), dt.parse_instant(col("b")))) == [0, 1]
        got = values(spark, "a string", [("2024-03-09 12:00:00",)], dt.plus_days(dt.parse_instant(col("a")), F.lit(1.5)))
        assert got == [dtm.datetime(2024, 3, 11)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_constant_columns_do_not_divide_by_zero(spark):
    from cargolith.plans import drift, evaluation as ev, features as f, selection as sel

    flat = spark.createDataFrame([(i, 1, 5.0, float(i)) for i in range(30)], "id int, y int, c double, x double")
    scores = {r.feature: r.score for r in sel.f_regression(flat.withColumn("t", col("x") * 2), ["c", "x"], "t").collect()}
    assert scores["x"] > 1e12 and scores["c"] is None
    assert sel.f_classification(flat, ["c", "x"], "y").count() == 2
    assert ev.regression_metrics(flat.select(col("c").alias("y"), col("x").alias("p"))).first().r2 is None
    assert ev.roc_auc(flat.select("y", col("x").alias("score"))).first().roc_auc is None
    assert drift.verdicts(flat, flat, ["c", "x"]).filter("drift_detected").count() == 0
    assert f.scaled(flat, ["c"], "minmax").agg(F.max("c_scaled")).first()[0] == 0.0


def test_folds_are_even_and_independent_of_the_split(spark):
    from cargolith.plans import models as m

    rows = spark.range(20000).select(m.fold_of("id", 5).alias("fold"), (m.split_share(F.col("id")) < 0.2).alias("test"))
    for r in rows.groupBy("fold").agg(F.count("*").alias("n"), F.avg(F.col("test").cast("int")).alias("share")).collect():
        assert 0.18 < r.n / 20000 < 0.22 and 0.17 < r.share < 0.23


@pytest.mark.parametrize(("given", "folded"), [("\u338f", "kg"), ("\u2474x", "1 x"), ("\U0001d400bc", "abc"), ("\ufb01n Société", "fin societe"), ("\u4e2d", "")])
def test_every_decomposition_is_folded(spark, given, folded):
    assert values(spark, "s string", [(given,)], text.fold_name(col("s"))) == [folded]
