"""lumenframe: single-molecule sequencing analytics, expressed as Spark DataFrame plans."""
