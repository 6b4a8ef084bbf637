"""DataFrame operators: CDC reads, columns, keys, lookups, SCD2, upsert."""
