"""Query-level operators: DataFrame in, DataFrame out."""
