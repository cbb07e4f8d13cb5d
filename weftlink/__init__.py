"""Record linkage and data processing as lazy Spark plans."""
