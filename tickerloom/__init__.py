"""Tickerloom: Spark jobs for entity time series and periodic statements."""
