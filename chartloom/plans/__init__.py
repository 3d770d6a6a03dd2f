"""End-to-end workflows, the test-table adapter and the registered query catalog."""
