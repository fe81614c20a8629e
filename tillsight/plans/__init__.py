"""Receipt audits: each function takes typed tables and returns a derived table."""
