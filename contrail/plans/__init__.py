"""Compositions: marts from raw tables, dashboard queries, declared tests, the query registry."""
