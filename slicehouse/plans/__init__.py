"""Jobs made of the other parts: import, export, manifest ingest and parameterised statements."""
