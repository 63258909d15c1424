"""tidemark: warehouse, metric, quality, streaming, retrieval and graph jobs on Spark DataFrames."""
