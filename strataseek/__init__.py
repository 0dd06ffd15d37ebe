"""Spatial analytics and document search as Spark DataFrame operators."""
