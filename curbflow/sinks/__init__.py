"""Writers for message topics, document indices and point archives."""
