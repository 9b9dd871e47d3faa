"""quire: document analytics as Spark DataFrame plans."""
