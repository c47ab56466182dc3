"""evidar: a Spark-native engine for evidence-bound matching and valuation."""
