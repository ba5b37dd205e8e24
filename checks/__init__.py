"""Every operator as a query over the test tables, and the SQL it must agree with."""
