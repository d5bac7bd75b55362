"""Booking and ad-spend analytics on Spark: ingest, silver, gold marts, serving, quality."""
