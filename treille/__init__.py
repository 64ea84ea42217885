"""Treille: a Spark-first engine for turning register and document data into a queryable corpus."""
