"""Promotion-response features and redemption scoring as Spark jobs."""
