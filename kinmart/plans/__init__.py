"""The star schema, its views, the quality gate, and the jobs that rebuild them."""
