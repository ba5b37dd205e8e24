"""Clickstream rollups on Spark DataFrames.

Layers, bottom up: ``functions`` (column expressions), ``operators`` (lazy
DataFrame -> DataFrame rollups), ``sources`` (event reads, rollup tables),
``plans`` (periods, single runs, backfills) and ``streaming``.
"""
