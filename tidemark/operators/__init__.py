"""DataFrame operators: schema, ranking, splits, features, models, tuning, metrics."""
