"""Payment-risk analytics on Spark: raw card events to bronze, alerts, metrics, silver, gold and audit."""
