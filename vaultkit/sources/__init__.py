"""Table readers, entity schemas and test-bed derivations from the driver's tables."""
