"""DataFrame operators: sampling, ranking, lemmas, features, naive Bayes, metrics."""
