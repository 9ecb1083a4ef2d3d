"""Medallion analytics on Spark: cleaning rules, table operators, sources and the movie-catalogue plans."""
