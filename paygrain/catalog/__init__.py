"""Every report and operator as a named query over the test tables, with its check SQL."""
