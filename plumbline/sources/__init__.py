"""Reading and writing tables, matrices, models and reports."""
