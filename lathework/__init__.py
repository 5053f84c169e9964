"""lathework: Spark-native processing of question/answer corpora and tables."""
