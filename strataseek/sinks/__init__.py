"""Writers: tables, partitioned tables, schema changes, JSON."""
