"""stagetrail: lifecycle-event analytics as PySpark DataFrame operators."""
