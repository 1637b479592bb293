"""Where rows go: files, catalog tables, database tables, staged swaps."""
