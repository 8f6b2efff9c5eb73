"""Reading and writing tables, and finding them."""
