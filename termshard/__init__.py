"""Text retrieval over document collections as Spark jobs."""
