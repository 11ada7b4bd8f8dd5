"""Where rows are written: the row log, keyed tables, other stores, a peek."""
