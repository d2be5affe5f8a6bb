"""Query plans: adapters over the driver tables, the query catalog and its SQL oracle."""
