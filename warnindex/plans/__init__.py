"""End-to-end flows and the query/oracle registries."""
