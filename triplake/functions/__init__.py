"""Column-level building blocks (all JVM-side ``pyspark.sql.functions``)."""
