"""Column-level building blocks: geometry, text and vector expressions."""
