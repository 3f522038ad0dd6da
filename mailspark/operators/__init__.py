"""DataFrame operators: term counts, vocabulary, weights, split, model,
evaluation and tuning."""
