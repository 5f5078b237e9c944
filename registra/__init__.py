"""Medallion analytics over monthly company-registry extracts, as Spark jobs."""
