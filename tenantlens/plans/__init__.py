"""Star schema, measures, report queries and the layer-by-layer build."""
