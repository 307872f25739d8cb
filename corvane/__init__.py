"""Analytics on PySpark: relational operators, readers, writers and ready-made analyses."""
