"""Geo-hazard analytics on Spark: quakes, fires and air quality on a one-degree grid."""
