"""Listing-price data preparation and price models on PySpark."""
