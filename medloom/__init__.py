"""medloom: a PySpark-native engine for document-entity analytics."""
