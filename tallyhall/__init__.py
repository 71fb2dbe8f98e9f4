"""Customer-analytics engine on Spark: cleaning, named questions, result tables."""
