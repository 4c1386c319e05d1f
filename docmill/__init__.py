"""Document-to-Markdown pipelines and their bookkeeping as Spark jobs."""
