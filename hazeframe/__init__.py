"""hazeframe: environmental analytics as Spark DataFrame operators."""
