"""Column-level functions: money, order sizes, composition, rendering."""
