"""rfspark: analytics over radio-frequency captures, written as Spark jobs."""
