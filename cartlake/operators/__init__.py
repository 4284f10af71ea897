"""DataFrame-in, DataFrame-out operators of the commerce lake."""
