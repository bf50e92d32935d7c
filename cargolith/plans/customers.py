"""Customer analytics: RFM, segments, profitability, lifetime value, risk, tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolith.functions.bins import risk_band
from cargolith.functions.dates import floor_days
from cargolith.functions.measures import clamp, rule_segment
from cargolith.operators.ranking import average_ranks, quantiles, quintile, quintile_cuts
from cargolith.operators.stats import attach
from cargolith.plans.kpis import known, net, rows, zero_sum
from cargolith.session import stash, tiny


def rfm_base(invoices: DataFrame, as_of: Column) -> DataFrame:
    """All customer measures from a single grouped pass."""
    first, last = F.min("InvoiceDate"), F.max("InvoiceDate")
    grouped = known(invoices, "CustomerKey").groupBy("CustomerKey").agg(
        first.alias("FirstPurchase"),
        last.alias("LastPurchase"),
        F.countDistinct("InvoiceID").alias("Frequency"),
        zero_sum(net()).alias("Monetary"),
        F.coalesce(F.avg(net()), F.lit(0.0)).alias("MonetaryMean"),
        F.coalesce(F.stddev_samp(net()), F.lit(0.0)).alias("MonetaryStd"),
        F.avg(F.when(F.col("PaymentStatus") == 1, 1.0).otherwise(0.0)).alias("PaymentRate"),
        zero_sum(F.col("TotalAmount")).alias("TotalSpent"),
    )
    life = F.coalesce(floor_days(F.col("LastPurchase"), F.col("FirstPurchase")), F.lit(0))
    return (
        grouped.withColumn("Recency", F.coalesce(floor_days(as_of, F.col("LastPurchase")), F.lit(0)))
        .withColumn("CustomerLifetime", life)
        .withColumn("AvgOrderValue", F.coalesce(F.try_divide("TotalSpent", "Frequency"), F.lit(0.0)))
        .withColumn("PurchaseVelocity", F.col("Frequency") / (F.col("CustomerLifetime") + 1))
    )


def rfm_scores(base: DataFrame) -> DataFrame:
    """Quintile scores by first-come ranks (ties by key); recency counts backwards.

    The customers are written once; the cuts come from a narrow run over the three measures, and each score is a
    comparison with its cuts.
    """
    measures = ["Recency", "Frequency", "Monetary"]
    held = stash(base, "rfm")
    out = attach(held, quintile_cuts(held, measures, "CustomerKey"))
    out = out.withColumns({
        "R_score": 6 - quintile("Recency", "CustomerKey"), "F_score": quintile("Frequency", "CustomerKey"), "M_score": quintile("Monetary", "CustomerKey")})
    return out.drop(*[f"cuts_{c}" for c in measures]).withColumn("CustomerValue", F.col("F_score") * F.col("M_score") * F.col("PaymentRate"))


def segments(scores: DataFrame) -> DataFrame:
    return scores.withColumn("Segment", rule_segment(F.col("R_score"), F.col("F_score"), F.col("M_score")))


def segment_profile(segmented: DataFrame) -> DataFrame:
    """Size, means and counts above the segment's own marks."""
    both = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in ("Monetary", "Frequency")]))
    each = quantiles(segmented.select("Segment", both), "value", {"p50": 0.5, "p80": 0.8}, ["Segment", "column"], few_keys=True)
    marks = each.groupBy("Segment").agg(
        F.max(F.when(F.col("column") == "Monetary", F.col("p80"))).alias("p80"), F.max(F.when(F.col("column") == "Frequency", F.col("p50"))).alias("p50"))
    # At most six rule labels, so the marks are broadcast and the profile is one pass.
    marked = segmented.join(tiny(marks), "Segment")

    def count_if(test: Column) -> Column:
        return F.sum(F.when(test, 1).otherwise(0))

    profile = marked.groupBy("Segment").agg(
        rows().alias("Size"),
        F.avg("Recency").alias("AvgRecency"),
        F.avg("Frequency").alias("AvgFrequency"),
        F.avg("Monetary").alias("AvgMonetary"),
        F.avg("PaymentRate").alias("AvgPaymentRate"),
        F.sum("Monetary").alias("TotalValue"),
        count_if(F.col("Monetary") > F.col("p80")).alias("HighValueCustomers"),
        count_if(F.col("Frequency") > F.col("p50")).alias("FrequentBuyers"),
        count_if(F.col("Recency") < 30).alias("RecentActivity"),
    )
    total = profile.agg(F.sum("Size").alias("__all"))
    return attach(profile, total).withColumn("Percentage", F.col("Size") * 100.0 / F.col("__all")).drop("__all")


def box_plot(segmented: DataFrame) -> DataFrame:
    """Five-number summary of spending per segment."""
    marks = {"Low": 0.0, "Q1": 0.25, "Median": 0.5, "Q3": 0.75, "High": 1.0}
    return quantiles(segmented, "Monetary", marks, ["Segment"], few_keys=True)


def profitability(invoices: DataFrame, cost_ratio: float = 0.7) -> DataFrame:
    grouped = known(invoices, "CustomerKey").groupBy("CustomerKey").agg(
        F.round(F.sum(net()), 2).alias("TotalRevenue"),
        F.round(F.round(F.sum(net()), 2) / F.count("NetAmount"), 2).alias("AvgOrderValue"),
        F.count("NetAmount").alias("OrderCount"),
        F.round(F.sum("TaxAmount"), 2).alias("TotalTax"),
        F.round(F.round(F.sum(net()), 2) * (1 - cost_ratio), 2).alias("TotalProfit"),
    )
    return grouped.withColumn("ProfitMargin", F.coalesce(F.try_divide("TotalProfit", "TotalRevenue"), F.lit(0.0)))


def with_segment(customers: DataFrame, segmented: DataFrame) -> DataFrame:
    return customers.join(segmented.select("CustomerKey", "Segment"), "CustomerKey", "left")


def segment_profitability(customers: DataFrame) -> DataFrame:
    """Over :func:`profitability` rows joined with their segment."""
    return known(customers, "Segment").groupBy("Segment").agg(
        F.sum("TotalRevenue").alias("TotalRevenue"),
        F.avg("TotalRevenue").alias("AvgRevenue"),
        F.sum("TotalProfit").alias("TotalProfit"),
        F.avg("TotalProfit").alias("AvgProfit"),
        F.sum("OrderCount").alias("OrderCount"),
        F.avg("ProfitMargin").alias("AvgMargin"),
    )


def top_customers(customers: DataFrame, n: int = 20) -> DataFrame:
    return customers.orderBy(F.col("TotalRevenue").desc(), "CustomerKey").limit(n)


def top_segments(by_segment: DataFrame, n: int = 5) -> DataFrame:
    return by_segment.orderBy(F.col("TotalProfit").desc(), "Segment").limit(n)


def best_customer(customers: DataFrame) -> DataFrame:
    """Argmax in one aggregate; the smaller key wins a tie."""
    order = F.struct(F.col("TotalRevenue"), -F.col("CustomerKey"))
    return customers.agg(F.max_by("CustomerKey", order).alias("TopCustomer"), F.max("TotalRevenue").alias("TotalRevenue"))


def lifetime_value(invoices: DataFrame, growth: float = 1.5) -> DataFrame:
    grouped = known(invoices, "CustomerKey").groupBy("CustomerKey").agg(
        zero_sum(net()).alias("TotalSpent"),
        F.avg(net()).alias("AvgOrderValue"),
        F.min("InvoiceDate").alias("FirstOrder"),
        F.max("InvoiceDate").alias("LastOrder"),
        F.count("InvoiceDate").alias("OrderCount"),
    )
    return (
        grouped.withColumn("CustomerAge", floor_days(F.col("LastOrder"), F.col("FirstOrder")))
        .withColumn("PurchaseFrequency", F.col("OrderCount") / (F.col("CustomerAge") + 1))
        .withColumn("PredictedLifespan", F.col("CustomerAge") * growth)
        .withColumn("EstimatedLTV", F.col("AvgOrderValue") * F.col("PurchaseFrequency") * F.col("PredictedLifespan"))
    )


def risk_scores(base: DataFrame) -> DataFrame:
    """Weighted recency, frequency and below-mean spending, each within [0, 1]."""
    scored = attach(base, base.agg(F.avg("Monetary").alias("__mean")))
    mean = F.col("__mean")
    return (
        scored.withColumn("RecencyRisk", clamp(F.col("Recency") / 365, 0.0, 1.0))
        .withColumn("FrequencyRisk", clamp(1 / (F.col("Frequency") + 1), 0.0, 1.0))
        .withColumn("MonetaryRisk", clamp(F.try_divide(mean - F.col("Monetary"), mean), 0.0, 1.0))
        .withColumn(
            "RiskScore", F.col("RecencyRisk") * 0.4 + F.col("FrequencyRisk") * 0.3 + F.col("MonetaryRisk") * 0.3
        )
        .withColumn("RiskCategory", risk_band(F.col("RiskScore"), 0.3, 0.6, ("Low Risk", "Medium Risk", "High Risk")))
        .drop("__mean")
    )


def revenue_tiers(customers: DataFrame) -> DataFrame:
    """Premium: best 15 % by revenue rank; Standard: up to 50 %; else Occasional."""
    ranks = average_ranks(customers, "TotalRevenue", descending=True)
    tier = F.when(F.col("avg_rank") <= F.col("n") * 0.15, "Premium").when(
        F.col("avg_rank") <= F.col("n") * 0.50, "Standard"
    ).otherwise("Occasional")
    return customers.join(
        ranks.select("TotalRevenue", F.col("avg_rank").alias("RevenueRank"), tier.alias("CustomerTier")), "TotalRevenue", "left"
    )


def value_quintile(df: DataFrame, column: str, name: str, reverse: bool = False) -> DataFrame:
    """Quintile by value edges: ties share a bin. Repeated edges are dropped, and the
    labels are dealt to the remaining bins in order."""
    probs = {f"e{i}": i / 5 for i in range(6)}
    edges = quantiles(df, column, probs).select(F.array_distinct(F.array(*probs)).alias("__edges"))
    placed = attach(df, edges)
    place = F.greatest(F.lit(1), F.size(F.filter("__edges", lambda e: e < F.col(column))))
    return placed.withColumn(name, (6 - place) if reverse else place).drop("__edges")


def standard_vector(df: DataFrame, features: list[str], name: str = "vector") -> DataFrame:
    """Adds the features as an array, each less its mean and over its population deviation (1 where that is 0); NULL counts as 0."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    stats = df.agg(F.array(*[F.avg(v) for v in values]).alias("__mean"), F.array(*[F.stddev_pop(v) for v in values]).alias("__dev"))
    scaled = [(v - F.col("__mean")[i]) / F.when(F.col("__dev")[i] == 0, 1.0).otherwise(F.col("__dev")[i]) for i, v in enumerate(values)]
    return attach(df, stats).withColumn(name, F.array(*scaled)).drop("__mean", "__dev")
