"""DataFrame operators: DataFrame in, DataFrame out, lazily planned."""
