"""Palmares: cleaning, enrichment and publication of degree records on Spark."""
