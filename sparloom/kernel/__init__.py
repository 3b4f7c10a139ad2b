"""Functions on one payload: no Spark here; operators wrap them in Arrow batches."""
