"""Query plans over the test tables: adapters, registered queries, oracles."""
