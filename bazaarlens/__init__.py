"""Listing collection, cleaning and price models as Spark jobs."""
