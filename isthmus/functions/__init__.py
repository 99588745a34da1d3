"""Value functions as Spark columns."""
