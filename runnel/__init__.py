"""runnel: gridded hydrology and flow-network analytics as Spark DataFrame plans."""
