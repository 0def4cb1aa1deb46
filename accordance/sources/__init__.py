"""Reading the data to be compared and the tables that describe the work."""
