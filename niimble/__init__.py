"""Net-interest-income forecasting on Spark: DataFrame in, DataFrame out."""
