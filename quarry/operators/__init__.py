"""DataFrame operators: indexing, compression, boolean search, signals, scoring, ranking, evaluation, learning."""
