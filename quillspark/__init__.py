"""A PySpark-native engine for preparing, validating, sampling and scoring fine-tuning data."""
