"""adloom: click-through-rate data preparation, profiling and evaluation as Spark DataFrame plans."""
