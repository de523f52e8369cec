"""A medallion analytics library on Spark: ingest, reduce, aggregate, serve and govern."""
