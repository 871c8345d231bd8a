"""Plans: the ordered model build, the training run and the query registry."""
