"""Customer features, churn labels and marketplace reports as Spark DataFrame jobs."""
