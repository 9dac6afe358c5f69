"""The test tables seen as a warehouse: inputs for the registered queries, and their SQL checks."""
