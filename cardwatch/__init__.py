"""Card-transaction risk analytics as plain ``DataFrame -> DataFrame`` jobs on Spark."""
