"""Turn a dirty transaction feed into trustworthy sales marts, on Spark."""
