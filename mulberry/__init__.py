"""Analytics on Spark: joins with strictness, array joins, table engines' read semantics, typed parameters, sources and sinks."""
