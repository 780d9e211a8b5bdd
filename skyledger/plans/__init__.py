"""Plans: from a source's rows to records, and from records to the served feed."""
