"""Evidence-set analytics on PySpark: cited question/answer rows in, clusters, work units and checks out."""
