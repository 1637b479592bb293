"""Where rows come from: databases, queries, Parquet datasets, range splits."""
