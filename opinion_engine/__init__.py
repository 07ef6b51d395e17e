"""Review-sentiment analytics as composable PySpark DataFrame operators."""
