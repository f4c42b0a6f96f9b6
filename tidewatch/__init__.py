"""Clickstream analytics on Spark: event-time metrics, anomaly alerts and serving queries."""
