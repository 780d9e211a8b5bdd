"""Registry analytics on Spark: heterogeneous registers in, one checked record set and lookup feed out."""
