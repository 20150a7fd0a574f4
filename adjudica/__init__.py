"""A Spark engine that validates, de-duplicates, adjudicates, curates and exports annotation datasets."""
