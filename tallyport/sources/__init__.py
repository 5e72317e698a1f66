"""Reading deliveries and tables; writing staged data, typed tables and reports."""
