"""weftlink: record linkage and training-data operators as Spark DataFrame plans."""
