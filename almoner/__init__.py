"""Development-aid analytics expressed as Spark DataFrame operators."""
