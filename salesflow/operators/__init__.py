"""Frame-level operators: aggregates, ordering, serving, quality, features, regression."""
