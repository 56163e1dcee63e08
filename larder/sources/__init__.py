"""Reading, landing, listing and writing tables and files."""
