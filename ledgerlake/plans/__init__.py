"""Jobs made of the operators: the layers of a lakehouse, and the chunk index."""
