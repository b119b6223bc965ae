"""Check suites, reports, marts and the load run, built from the operators."""
