"""Logistics and trade analytics on Spark: star-schema builds, KPIs, customer
analytics, forecasting, drift monitoring and models as DataFrame jobs."""
