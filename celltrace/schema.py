"""Keys of the working tables."""

# Key of one cell. The cell name alone repeats across samples.
CELL = ["sample", "cell"]
