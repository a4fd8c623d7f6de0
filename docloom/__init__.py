"""Spark-native engine that turns filings into verified question-answer datasets."""
