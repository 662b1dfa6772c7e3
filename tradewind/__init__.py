"""Retail analytics on Spark: CSV ingest, business queries, demand forecast, recommendation.

Every job takes DataFrames and returns a lazy DataFrame; see ``tradewind.plans`` for the jobs,
``tradewind.sources`` for ingest, ``tradewind.operators`` and ``tradewind.functions`` for the parts.
"""
