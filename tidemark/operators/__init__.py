"""Lazy DataFrame -> DataFrame rollups. Nothing here runs a Spark action."""
