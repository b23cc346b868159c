"""Network-forensics analytics over many cases at once, as Spark DataFrame operators."""
