"""decisionloom: decision-document analytics as Spark DataFrame plans."""
