"""The daily run and the registered queries."""
