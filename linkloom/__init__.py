"""Page popularity ranking, dump filtering and link embeddings as Spark jobs."""
