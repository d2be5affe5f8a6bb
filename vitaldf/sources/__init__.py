"""One module per app export: discovery, reading and normalisation."""
