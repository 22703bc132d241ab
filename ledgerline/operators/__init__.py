"""DataFrame-in, DataFrame-out operators, parameterised by column names."""
