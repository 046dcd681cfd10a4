"""Table operators: DataFrame in, DataFrame out, no data on the driver."""
