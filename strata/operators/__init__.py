"""Generic operators: staging, upsert, joins, quality rules, retrieval, SQL surface."""
