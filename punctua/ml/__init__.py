"""Training sets, classifiers, evaluation and scoring on Spark ML."""
