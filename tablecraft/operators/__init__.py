"""DataFrame-in, DataFrame-out operators and analyses."""
