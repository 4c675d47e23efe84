"""Named query plans over the driver tables, and the SQL oracles that check them."""
