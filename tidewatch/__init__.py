"""Vessel-traffic analytics on PySpark: cleaning, dwell, KPIs, proximity, clustering, serving."""
