"""Training-data operators: text, vector and archive work on Spark."""
