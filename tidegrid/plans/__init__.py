"""Jobs, report tables and the registered queries."""
