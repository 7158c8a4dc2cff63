"""After-sales defect analytics as Spark DataFrame operators."""
