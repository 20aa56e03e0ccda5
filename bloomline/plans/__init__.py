"""Jobs, adapters onto the benchmark tables, and the registered queries."""
