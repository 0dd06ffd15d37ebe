"""Readers for landed files: event and boundary GeoJSON, papers, text and binary files."""
