"""Named plans: the queries of the core operators and the same results in SQL."""
