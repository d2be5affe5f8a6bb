"""DataFrame operators: records, tables, queries, aggregates, store, quality."""
