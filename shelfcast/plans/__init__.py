"""Plans: named queries over the panel, the feature matrix, reports and model fits."""
