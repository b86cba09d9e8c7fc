"""Plans: the pipeline of rules and routes, and the catalogue of queries."""
