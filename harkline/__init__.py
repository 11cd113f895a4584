"""Media-annotation analytics on Spark: catalogue, plan, annotate, analyse."""
