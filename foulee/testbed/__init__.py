"""The operators on the generated star-schema tables: adapters, query catalogue and SQL twins."""
