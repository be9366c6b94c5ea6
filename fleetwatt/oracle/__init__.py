"""SQL texts that the queries are checked against."""
