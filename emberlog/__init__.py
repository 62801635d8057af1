"""emberlog: operational-log analytics as Spark plans."""
