"""Models of the lake: silver, gold, marts, cross-domain profile, recipes, semantic layer."""
