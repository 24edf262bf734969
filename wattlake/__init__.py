"""Electricity-mix and carbon analytics as Spark DataFrame jobs.

Layers: raw JSON events -> silver (every arrival) -> gold (latest arrival per
region and time) -> features, model, forecast, supervision reports.
"""
