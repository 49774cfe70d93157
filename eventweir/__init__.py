"""eventweir: event-sequence analytics on Spark DataFrames."""
