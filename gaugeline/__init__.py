"""River and reservoir monitoring analytics as Spark DataFrame operators."""
