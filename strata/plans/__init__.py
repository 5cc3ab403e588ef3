"""Plans: the layer pipelines and the named queries over the fixture tables."""
