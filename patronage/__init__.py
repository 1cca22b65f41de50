"""Customer purchase analytics as Spark DataFrame programs."""
