"""Plans: how operators combine into the warehouse, its marts and its reports."""
