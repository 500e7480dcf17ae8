"""DataFrame operators: relational, aggregates, windows, folds, sampling."""
