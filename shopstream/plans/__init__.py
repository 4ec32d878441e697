"""Gold tables, reports and the table graph."""
