"""Every operator as a query over the given tables, with the SQL that checks it."""
