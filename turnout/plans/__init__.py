"""Plans: composition of the models into jobs."""
