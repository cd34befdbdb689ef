"""rekko: rating prediction and item recommendation as Spark DataFrame jobs."""
