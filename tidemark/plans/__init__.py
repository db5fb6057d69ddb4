"""Query plans: gold views, registered driver queries, layer runners."""
