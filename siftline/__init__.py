"""A Spark-native engine for session evidence: census, packing, grouping, review."""
