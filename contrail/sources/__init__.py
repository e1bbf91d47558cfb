"""Raw files, mart tables, and the adapters that derive raw tables from a star schema."""
