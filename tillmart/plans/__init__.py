"""Jobs, the sample mapping and the registered queries."""
