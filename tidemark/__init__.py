"""Event journal, state folds and snapshot reconciliation as Spark DataFrame programs."""
