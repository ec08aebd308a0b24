"""factloom: a Spark-native engine for observation data (merge, resolve, reduce, report)."""
