"""Pipelines built from the operators: geospatial tables, document index, search study."""
