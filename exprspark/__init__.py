"""Count-matrix analytics and differential expression as Spark DataFrame programs."""
