"""docloom: a PySpark engine that cleans, reshapes, chunks and publishes document collections."""
