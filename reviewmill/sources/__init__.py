"""Reading and writing: review tables, lexicons, word lists, reports."""
