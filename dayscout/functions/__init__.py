"""Column expressions: everything here maps Columns to Columns, no UDFs."""
