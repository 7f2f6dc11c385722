"""The data jobs: cleaning, star schema, business reports."""
