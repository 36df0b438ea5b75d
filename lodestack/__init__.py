"""Document retrieval and knowledge-graph analytics as Spark jobs."""
