"""Table operators: transforms, filters, pairwise, aggregates, metrics."""
