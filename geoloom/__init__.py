"""geoloom: urban geospatial data preparation as Spark DataFrame operators."""
