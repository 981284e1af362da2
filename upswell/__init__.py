"""Upswell: momentum ranking of companies from news, crawled pages and claims, on Spark."""

__version__ = "0.1.0"
