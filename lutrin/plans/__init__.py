"""Plans: the steps of each domain, from staging rows to rows ready to be written."""
