"""End-to-end flows and the catalogue of checked queries."""
