"""Reading and writing of tables, and badges derived from an event table."""
