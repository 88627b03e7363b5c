"""Rail push-feed analytics on Spark DataFrames, batch and streaming alike."""
