"""Logistics analytics on Spark: raw shipments -> star schema -> checks, KPIs, streams, models."""
