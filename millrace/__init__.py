"""millrace: a Spark-first engine for curating and analysing machine-learning datasets."""
