"""Query plans over the warehouse tables and the load pipeline."""
