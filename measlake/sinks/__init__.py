"""Writers for the four tables and their exports."""
