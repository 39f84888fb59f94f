"""Retail medallion analytics on Spark: bronze, silver, gold, checks, reports."""
