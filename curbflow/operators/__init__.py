"""DataFrame operators; the row-wise ones and the windowed counts also run on streams."""
