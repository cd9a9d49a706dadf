"""End-to-end runs: the daily batch, the test-table roles and the registered queries."""
