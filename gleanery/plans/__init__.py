"""End-to-end jobs and the catalogue of checked queries."""
