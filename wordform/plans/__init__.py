"""Stage plans and the harness queries."""
