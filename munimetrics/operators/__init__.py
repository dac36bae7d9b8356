"""DataFrame-in, DataFrame-out operators, free of domain column names unless given as defaults."""
