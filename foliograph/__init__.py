"""foliograph: Spark-native building of question/answer datasets from scanned documents."""
