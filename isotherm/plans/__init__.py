"""Plans: the end-to-end batch job, the query catalog and oracle checks."""
