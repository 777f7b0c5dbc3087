"""Season analytics on Spark: refresh, form, standings, features and outcome models."""
