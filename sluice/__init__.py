"""Record streams in and out of object storage, as Spark DataFrame jobs."""
