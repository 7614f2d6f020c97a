"""Knowledge-graph building on Spark: DataFrame in, DataFrame out."""
