"""Learning-progress analytics on Spark: DataFrame-in, DataFrame-out operators and reports."""
