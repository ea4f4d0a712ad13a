"""Every operator and report run over the test tables, next to the SQL that must agree with it."""
