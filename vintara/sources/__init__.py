"""Reading landed files, the control log, and partitioned table writes."""
