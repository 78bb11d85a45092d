"""Analytics over database change streams, as Spark DataFrames."""
