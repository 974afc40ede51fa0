"""Input relations: catalog tables and test fixtures."""
