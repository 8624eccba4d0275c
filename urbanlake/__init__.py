"""urbanlake: Spark jobs that turn raw collected urban data into clean tables."""
