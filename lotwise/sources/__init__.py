"""Reading landed pages and stored tables, writing tables, labels and map files."""
