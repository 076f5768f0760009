"""The operators re-aimed at the driver's tables, with the SQL each one must agree with."""
