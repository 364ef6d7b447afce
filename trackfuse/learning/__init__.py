"""Training, evaluation and scoring with Spark ML."""
