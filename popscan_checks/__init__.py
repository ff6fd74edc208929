"""Check SQL for DuckDB: the same results by independent, direct queries.

Nothing here is used by the engine. Distributions number all rows instead of
building histograms, calendars use range joins, orphans use outer joins.
"""
