"""Card-shaped inputs over the given tables, the registered queries, and the SQL they are checked against."""
