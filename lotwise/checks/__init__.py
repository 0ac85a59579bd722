"""The registered queries, their input views over the given tables, and the SQL to check them."""
